"""Text helpers against the public libraries, on awkward and random texts."""

import random
from array import array
from collections import Counter
from dataclasses import replace
from functools import cache

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerstar.llm import lexical, licenses, ngrams, pieces, vafile, warc
from ledgerstar.llm.common import WordTokenizer
from ledgerstar.llm.crc32c import crc32c, masked
from ledgerstar.llm.queries import BYTE_BPE, PIECE_BPE

AWKWARD = ["", "a", "\n", "a\nb", " a", "a  b", "a ", "it's\n'tis  x \n y", "\n\n", "<|endoftext|>"]
LETTERS = " \n\t\r\x1c　a b.,'s12éÀßˤ日cd\u200b\x00😀"


@pytest.fixture(scope="module")
def model():
    return shared_model()


def test_word_tokenizer_gives_the_ids_of_the_library():
    words = WordTokenizer(BYTE_BPE, most_words=50)
    random.seed(1)
    texts = AWKWARD + [
        "".join(random.choice(LETTERS) for _ in range(random.randint(0, 30))) for _ in range(3000)
    ]
    parts = [pa.array(texts[at : at + 3]) for at in range(0, len(texts), 3)]
    found = [ids for part in parts for ids in words.encode(part)]
    wanted = words.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert found == [array("H", e.ids).tobytes() for e in wanted]


def _varint(data, at):
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        shift, at = shift + 7, at + 1
        if byte < 128:
            return value, at


def _bytes_of(value):
    out = b""
    while value > 127:
        out, value = out + bytes([value & 127 | 128]), value >> 7
    return out + bytes([value])


def unigram_twin(path):
    """The same pieces and scores as a unigram model, which the library can search n-best.

    In the model file, field 2 holds the trainer's settings, whose field 3 is the kind of model.
    """
    raw, out, at = open(path, "rb").read(), b"", 0
    while at < len(raw):
        start = at
        tag, at = _varint(raw, at)
        size, at = _varint(raw, at)
        body, at = raw[at : at + size], at + size
        if tag >> 3 != 2:
            out += raw[start:at]
            continue
        settings_, inner = b"", 0
        while inner < len(body):
            begin = inner
            field, inner = _varint(body, inner)
            if field & 7 == 0:
                _, inner = _varint(body, inner)
            elif field & 7 == 2:
                length, inner = _varint(body, inner)
                inner += length
            else:
                inner += 4 if field & 7 == 5 else 8
            same = body[begin:inner]
            settings_ += _bytes_of(field) + b"\x01" if field >> 3 == 3 else same
        out += _bytes_of(tag) + _bytes_of(len(settings_)) + settings_
    twin = sentencepiece.SentencePieceProcessor()
    twin.LoadFromSerializedProto(out)
    return twin


def test_n_best_equals_the_library(model):
    twin = unigram_twin(PIECE_BPE)
    random.seed(2)
    texts = ["The cat sat on the mat", "thinking of others"] + [
        "".join(random.choice("abtheion rs") for _ in range(random.randint(1, 16))).strip() or "a"
        for _ in range(200)
    ]
    texts = [" ".join(t.split()) for t in texts]
    for text, found in zip(texts, pieces.Solver(model).solve(texts, 4)):
        scores = [score * pieces.UNIT for score, _ in found]
        if min(scores) < -1e8:
            continue  # the library's 32-bit sums are not exact there
        wanted = [
            sum(twin.get_score(i) for i in ids) for ids in twin.nbest_encode_as_ids(text, 4)
        ]
        assert scores == sorted(wanted, reverse=True)


@cache
def shared_model():
    return pieces.PieceModel.load(PIECE_BPE)


def all_paths(model, text):
    if not text:
        yield 0
        return
    for end in range(1, len(text) + 1):
        if text[:end] in model.scores:
            for rest in all_paths(model, text[end:]):
                yield model.scores[text[:end]][1] + rest
    if text[0] not in model.scores:
        for rest in all_paths(model, text[1:]):
            yield model.unknown_score + rest


@settings(max_examples=60, deadline=None)
@given(st.text("ab the\n日ﬁ", max_size=9))
def test_n_best_equals_all_segmentations(text):
    model = shared_model()
    [found] = pieces.Solver(model).solve([text], 5)
    scores = [s for s, _ in found]
    spelled = "▁" + text.replace(" ", "▁") if text else ""
    wanted = sorted(all_paths(model, spelled), reverse=True)
    assert scores == wanted[:5]
    assert len({ids for _, ids in found}) == len(found)
    for _, ids in found:
        assert pieces.decode_ids(model, np.frombuffer(ids, "<u4")) == text


def test_decode_as_the_library(model):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    for text in ["a b", " x  y\t", "日本ﬁ½", "", "é\n"]:
        ids = library.encode(text)
        assert pieces.decode_ids(model, np.array(ids, np.int32)) == library.decode(ids) == text


def test_crc32c_of_known_values():
    # Published check values of the polynomial.
    assert crc32c([b"123456789", b"", bytes(32), b"\xff" * 32]) == [
        0xE3069283, 0, 0x8A9136AA, 0x62A8AB43,
    ]
    assert masked([0]) == [0xA282EAD8]
    long = bytes(range(256)) * 5
    parts = crc32c([long, long[:3], long[:4], long[:255], long[:256], long[:257]])
    plain = []
    for item in [long, long[:3], long[:4], long[:255], long[:256], long[:257]]:
        crc = 0xFFFFFFFF
        for byte in item:
            crc ^= byte
            for _ in range(8):
                crc = crc >> 1 ^ (0x82F63B78 if crc & 1 else 0)
        plain.append(crc ^ 0xFFFFFFFF)
    assert parts == plain


def every_block(template, text):
    """All minimal runs of words that hold enough of a template, by looking at every run."""
    held = lambda a, b: len(template.different.intersection(text[a:b]))
    last = lambda a: min(len(text), a + template.width)
    good = {
        (a, b)
        for a in range(len(text))
        for b in range(a + 1, last(a) + 1)
        if held(a, b) >= template.overlap
    }
    for a, b in good:
        if (a + 1, b) not in good and (a, b - 1) not in good:
            share, stop = max((held(a, e), -e) for e in range(b, last(a) + 1))
            yield a, -stop, share / len(template.different)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c", b"d", b"e", b"x", b"y"]), max_size=25))
def test_blocks_equal_all_blocks(text):
    """A notice gives every minimal run of words that holds enough of it, and nothing else."""
    notice = licenses.Template("n", (b"a", b"b", b"c", b"d", b"e"), False, 0.6)
    phrase = licenses.Template("p", (b"a", b"b"), True, 1.0)
    counts = {b"a": 5, b"b": 1, b"c": 9, b"d": 2, b"e": 7}
    found = licenses.Index([notice, phrase], counts).matches(text)
    assert sorted(m[1:] for m in found if m[0] == 0) == sorted(every_block(notice, text))
    starts = sorted(s for t, s, _, _ in found if t == 1)
    assert starts == [i for i in range(len(text) - 1) if text[i : i + 2] == [b"a", b"b"]]


def test_notices_side_by_side_are_both_found():
    scan = licenses.templates()
    text = licenses.words(
        "Licensed under the Apache License, Version 2 "
        "Licensed under the Apache License, Version 2.0."
    )
    index = licenses.Index(scan, {w: 1 for t in scan for w in t.words})
    at = next(i for i, t in enumerate(scan) if t.label == "apache-notice")
    found = sorted(m[1:] for m in index.matches(text) if m[0] == at)
    assert (0, 7, 7 / 8) in found and (7, 15, 1.0) in found


@pytest.mark.parametrize("run", ["-", " ", "a", "ab", "=-+"])
def test_long_runs_are_segmented(model, run):
    """Ties without number: three segmentations in a moment, the best by forward scores."""
    text = (run * 100_000)[:100_000] if run != " " else " " * 100_000
    [found] = pieces.Solver(model).solve([text], 3)
    scores, ids = zip(*found)
    assert len(set(ids)) == 3 and sorted(scores, reverse=True) == list(scores)
    best = [0]
    spelled = pieces.SPACE + text.replace(" ", pieces.SPACE)
    for end in range(1, len(spelled) + 1):
        options = [
            best[a] + score[1]
            for a in range(max(0, end - model.longest), end)
            if (score := model.scores.get(spelled[a:end]))
        ]
        if spelled[end - 1] not in model.scores:
            options.append(best[end - 1] + model.unknown_score)
        best.append(max(options))
    assert scores[0] == best[-1]


def test_scores_beyond_62_bits(model, monkeypatch):
    units = model.units.copy()
    units[model.scores["a"][0]] = -(1 << 60)
    scores = {k: (i, int(units[i])) for k, (i, _) in model.scores.items() if set(k) <= {"a"}}
    heavy = replace(model, units=units, scores=scores)
    [found] = pieces.Solver(heavy).solve(["b" + "a" * 7], 1)
    assert found[0][0] < 0


def test_added_tokens_are_those_of_the_library():
    library = Tokenizer.from_file(BYTE_BPE)
    texts = [
        "<|endoftext|>", "x<|endoftext|>y", " <|endoftext|> ", "a b <|endof text|> c",
        "line\n<|endoftext|>\nline", "<|endoftext|><|endoftext|>", "no token here",
    ]
    found = WordTokenizer(BYTE_BPE).encode(pa.array(texts))
    for text, ids in zip(texts, found):
        wanted = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u2").tolist() == wanted
    assert 50256 in np.frombuffer(found[1], "<u2")


def test_dates_of_captures():
    assert warc.printed(0) == "2026-01-01T00:00:00Z"
    assert warc.printed(-1) == "2025-12-31T23:59:59Z"
    assert warc.printed(1 << 62) == "9999-12-31T23:59:59Z"
    assert warc.printed(-(1 << 62)) == "0001-01-01T00:00:00Z"


def jaccard_links(sets, percent):
    return [
        (i, j)
        for i, x in enumerate(sets)
        for j, y in enumerate(sets[:i])
        if 100 * len(x & y) >= percent * len(x | y) > 0
    ]


def parts_of(size, links):
    part = list(range(size))
    for _ in range(size):
        for i, j in links:
            part[i] = part[j] = min(part[i], part[j])
    return part


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.sets(st.integers(0, 14), min_size=1, max_size=15), min_size=1, max_size=14),
    st.sampled_from([30, 60, 85]),
)
def test_t_occurrence_links_equal_all_pairs(sets, percent):
    members = [
        {"no": i, "label": i, "shingles": np.array(sorted(s), "<u8").tobytes()}
        for i, s in enumerate(sets)
    ]
    wanted = jaccard_links(sets, percent)
    found = ngrams.links_within(members, percent)
    assert {tuple(sorted(x)) for x in found} <= {tuple(sorted(x)) for x in wanted}
    assert parts_of(len(sets), found) == parts_of(len(sets), wanted)
    half = len(members) // 2
    across = ngrams.links_across(members[:half], members[half:], percent)
    cross = [(i, j) for i, j in wanted if (i < half) != (j < half)]
    assert parts_of(len(sets), across) == parts_of(len(sets), cross)


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.lists(st.integers(0, 30), unique=True).map(sorted), max_size=8),
    st.integers(1, 4), st.integers(0, 10), st.integers(11, 31),
)
def test_merge_counts_as_a_scan_does(lists, least, begin, stop):
    counts = {n: sum(n in some for some in lists) for n in range(begin, stop)}
    wanted = [(n, c) for n, c in counts.items() if c >= least]
    assert list(ngrams.merge(lists, begin, stop, least)) == wanted


def test_linked_sets_share_enough_signatures():
    random = np.random.default_rng(3)
    linked = 0
    for trial in range(3000):
        size = int(random.integers(1, 40 if trial % 2 else 600))
        x = np.unique(random.integers(0, 1 << 63, size).astype(np.uint64))
        gone, new = random.integers(0, len(x) // 6 + 2, 2)
        fresh = random.integers(0, 1 << 63, new).astype(np.uint64)
        y = np.unique(np.concatenate([random.permutation(x)[gone:], fresh]))
        both = len(np.intersect1d(x, y))
        if not len(y) or 100 * both < 85 * (len(x) + len(y) - both) or both == len(x) == len(y):
            continue
        linked += 1
        (a, ask), (b, ask2) = ngrams.signatures(x, 85), ngrams.signatures(y, 85)
        assert any(
            len(np.intersect1d(a[ask == k], b[ask2 // ngrams._ASK == k // ngrams._ASK]))
            >= max(k % ngrams._ASK, 1)
            for k in set(ask.tolist())
        )
    assert linked > 1000


def test_bounds_of_scores_hold():
    """No document's bound is below its score, and searching equals scoring all."""
    random = np.random.default_rng(4)
    words = [f"w{i}".encode() for i in range(300)]
    block, counted = lexical._Block(), []
    for doc in range(200):
        some = random.zipf(1.4, int(random.integers(1, 400))) % len(words)
        counted.append(Counter(words[i] for i in some))
        block.add(doc if doc % 7 else None, counted[-1])
    row = block.row(5).to_pylist()[0]
    total, length = 200, sum(sum(c.values()) for c in counted)
    known = words + [b"nowhere"]
    places = [np.array(sorted(set(random.integers(0, 301, 12)))) for _ in range(20)]
    weights = [random.integers(1, 9000, len(p)) for p in places]
    queries = lexical.Queries(list(range(20)), known, places, weights, [1] * 20)
    opened = lexical.Block(row, queries, total, length)
    every = np.arange(200)
    for p, w in zip(places, weights):
        scores = []
        for c in counted:
            m = 50 + (50 * sum(c.values()) * total) // length
            scores.append(sum(
                int(x) * ((10**9 * c[known[i]]) // (1000 * c[known[i]] + 20 * m))
                for i, x in zip(p, w)
            ))
        exact = opened.exact(every, p, w)
        assert exact.tolist() == scores
        bound = (w.astype(np.float32) @ opened.bounds[p]) * 1.0001 + 1
        assert (bound >= exact).all()
        ids, found = opened.search(p, w, 1, 10)
        ranked = sorted((-s, -1 << 63 if i % 7 == 0 else i) for i, s in enumerate(scores) if s)
        assert list(zip((-found).tolist(), ids.tolist())) == ranked[:10]


def test_intervals_hold_every_distance():
    random = np.random.default_rng(6)
    for dims, spread in ((64, 100), (3, 5), (1, 1 << 26)):
        values = random.integers(-spread, spread + 1, (500, dims))
        points = random.integers(-spread, spread + 1, (7, dims))
        low, high = values.min(axis=0), values.max(axis=0)
        cells = ((values - low) // vafile._width(low, high)).astype(np.uint8)
        row = {"rows": 500, "cells": cells.tobytes(), "low": low.tobytes(), "high": high.tobytes()}
        near, far = vafile.intervals(row, points)
        middle = points.sum(axis=0) // len(points)
        common = ((values - middle) ** 2).sum(axis=1)[:, None]
        true = vafile.distances(values, points) - common
        assert (near <= true).all() and (true <= far).all()
