"""Every query of the training-data operators at the smallest scale, by SQL or brute force."""

import base64
import hashlib
import re
import zlib
from collections import defaultdict
from unicodedata import category

import numpy as np
import pytest
import xxhash
from conftest import SMALL
from parity import connect, difference
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerstar.llm import licenses, pieces, toxicity
from ledgerstar.llm.common import table
from ledgerstar.llm.queries import BYTE_BPE, ORACLES, PIECE_BPE, QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.fixture(scope="module")
def docs(con):
    rows = con.execute("select doc_id, coalesce(text, '') from documents").fetchall()
    return dict(rows)


@pytest.fixture(scope="module")
def token_ids(docs):
    return library_ids(docs)


def library_ids(docs):
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    return {i: tokenizer.encode(t, add_special_tokens=False).ids + [0] for i, t in docs.items()}


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def rows_of(spark, name):
    return [r.asDict() for r in QUERIES[name](spark, SMALL).collect()]


@pytest.mark.parametrize("name", ORACLES)
def test_equals_sql(spark, con, name):
    found = QUERIES[name](spark, SMALL).toArrow()
    assert difference(found, con.sql(ORACLES[name]).to_arrow_table()) is None


def test_op1(spark, docs):
    model = pieces.PieceModel.load(PIECE_BPE)
    found = rows_of(spark, "op1_sentencepiece")
    assert {r["doc_id"] for r in found} == set(docs) and len(found) == len(docs)
    for r in found:
        assert r["same_text"]
        assert r["score"] >= r["second_score"] >= r["third_score"]
    # The best score by a plain dynamic programme over the whole text.
    for r in found[:20]:
        text = "▁" + docs[r["doc_id"]].replace(" ", "▁")
        best = [0]
        for end in range(1, len(text) + 1):
            options = [
                best[a] + model.scores[text[a:end]][1]
                for a in range(max(0, end - 31), end)
                if text[a:end] in model.scores
            ]
            if text[end - 1] not in model.scores:
                options.append(best[end - 1] + model.unknown_score)
            best.append(max(options))
        assert r["score"] == best[-1] * pieces.UNIT


def test_op2(spark, docs):
    phrases = {tuple(p.split()): label for p, label in licenses.PHRASES.items()}
    for r in rows_of(spark, "op2_license_scan"):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(docs[r["doc_id"]]))
        places = [
            (i, label)
            for phrase, label in phrases.items()
            for i in range(len(words))
            if tuple(words[i : i + len(phrase)]) == phrase
        ]
        starts = [i for i, _ in places]
        assert r["n_words"] == len(words) and r["n_base"] == len(places)
        assert r["first_word"] == min(starts, default=None)
        assert r["last_word"] == max(starts, default=None)
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1


def test_op4(spark, docs, token_ids):
    found = {r["doc_id"]: r for r in rows_of(spark, "op4_token_records")}
    start = 0
    for doc_id in sorted(docs):
        ids, r = token_ids[doc_id], found[doc_id]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), crc(ids))
        start += len(ids)


def test_op6(spark, con, docs):
    found = {r["doc_id"]: r for r in rows_of(spark, "op6_toxicity")}
    assert set(found) == set(docs)
    for doc_id, r in found.items():
        assert r["held_out"] == (zlib.crc32(str(doc_id).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    toxic = dict(con.execute("select doc_id, toxic from labels").fetchall())
    clean = [found[i]["predicted"] for i, t in toxic.items() if not t]
    assert sum(clean) <= 0.02 * len(clean)


def brute_toxicity(spark, con, docs):
    """Tokens, clauses, events and scores once more, from the fitted weights alone."""
    grammar = toxicity.fit(
        table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    )
    listed = {w: "rnpt"[k] for k in (3, 2, 1, 0) for w in (
        toxicity.REPORTS, toxicity.NEGATIONS, toxicity.TARGETS, toxicity.THREATS)[k]}

    def lexical(word):
        if word in listed:
            return 0.0
        key = hashlib.sha256(word.encode()).hexdigest() if len(word) >= 64 else word
        if key in grammar.words:
            return grammar.words[key]
        for size in (6, 5, 4):
            if word[:size] in grammar.stems:
                return grammar.stems[word[:size]]
        return 0.0

    def spelled(text):
        """Words go on while characters are letters, digits or combining marks."""
        found, word = [], ""
        for c in text.lower() + "\n":
            if c.isalnum() or (word and category(c).startswith("M")):
                word += c
                continue
            if word:
                found.append(word)
            word = ""
            if c in ".!?;:,\n":
                found.append(None)
        return found

    def events(clause):
        for at, word in enumerate(clause):
            own = lexical(word)
            before = clause[:at]
            near = lambda kind, reach: any(listed.get(w) == kind for w in before[-reach:])
            reported, negated = any(listed.get(w) == "r" for w in before), near("n", 3)
            if own:
                kind = "negated" if negated else "reported" if reported else None
                yield kind or ("targeted" if near("p", 4) else "insult"), (own / 4) ** 3
            elif listed.get(word) == "p" and near("t", 4):
                yield ("mild_threat" if negated or reported else "threat"), 1.0

    scores = {}
    for doc_id, text in docs.items():
        totals, clause = dict.fromkeys(toxicity.EVENTS, 0.0), []
        for word in spelled(text):
            if word is not None:
                clause.append(word)
                continue
            for event, size in events(clause):
                totals[event] += size
            clause = []
        x = [1.0, *np.log1p([totals[e] for e in toxicity.EVENTS])]
        scores[doc_id] = 1 / (1 + np.exp(-np.clip(x @ grammar.weights, -30, 30)))
    return scores


def test_op6_equals_a_plain_grammar(spark, con, docs):
    wanted = brute_toxicity(spark, con, docs)
    for r in rows_of(spark, "op6_toxicity"):
        assert abs(r["score"] - wanted[r["doc_id"]]) < 1e-9


def brute_fingerprint(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", lower(text)) if w]
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(codes):
    """Smallest id reachable from each id over links of at most two bits."""
    ids = sorted(codes)
    component = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if (codes[a] ^ codes[b]).bit_count() <= 2 and component[b] < component[a]:
                    component[a], changed = component[b], True
    return component


def test_op7(spark, docs):
    codes = {i: brute_fingerprint(t) for i, t in docs.items()}
    component = brute_components(codes)
    found = rows_of(spark, "op7_simhash_near_dedup")
    assert len(found) == len(docs)
    for r in found:
        assert r["fingerprint"] == f"{codes[r['doc_id']]:016x}"
        assert r["component_id"] == component[r["doc_id"]]


def check_packing(rows, token_ids, capacity=2048):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(token_ids)
    for doc_id, own in by_doc.items():
        ids, at = token_ids[doc_id], 0
        for number, r in enumerate(sorted(own, key=lambda r: r["piece"])):
            assert r["piece"] == number and r["start"] == at
            assert r["ids_crc32"] == crc(ids[at : at + r["length"]])
            assert r["length"] == capacity or number == 0
            at += r["length"]
        assert at == len(ids)
        assert len(own) == -(-len(ids) // capacity)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    total = sum(map(len, token_ids.values()))
    assert len(by_sequence) <= 1.02 * -(-total // capacity) + 1


def test_op8(spark, token_ids):
    check_packing(rows_of(spark, "op8_best_fit_packing"), token_ids)


def test_op9(spark, con):
    pages = con.execute("select page_id, coalesce(html, ''), url from pages").fetchall()
    keeper = {}
    for page_id, html, _ in pages:
        keeper[html] = max(keeper.get(html, -1), page_id)
    found = {r["page_id"]: r for r in rows_of(spark, "op9_warc_index_merge")}
    assert len(found) == len(pages)
    for page_id, html, _ in pages:
        r, first = found[page_id], keeper[html] == page_id
        assert r["payload_bytes"] == len(html.encode())
        digest = base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        assert r["payload_digest"] == digest
        assert r["record_type"] == ("response" if first else "revisit")
        assert r["refers_to"] == (None if first else keeper[html])
    order = sorted(found.values(), key=lambda r: r["place"])
    assert [r["place"] for r in order] == list(range(len(pages)))
    assert [(r["url_key"], r["page_id"]) for r in order] == sorted(
        (r["url_key"], r["page_id"]) for r in order
    )


def test_pipeline(spark, con, docs):
    """The kept documents follow from the stages' own rules, applied one after another."""
    scores = {r["doc_id"]: r["predicted"] for r in rows_of(spark, "op6_toxicity")}
    left = {i: t for i, t in docs.items() if not scores[i]}
    by_text = {}
    for i in sorted(left):
        by_text[left[i]] = i
    left = {i: left[i] for i in by_text.values()}
    component = brute_components({i: brute_fingerprint(t) for i, t in left.items()})
    left = {i: t for i, t in left.items() if component[i] == i}
    rows = [r.asDict() for r in corpus_pipeline.run(spark, SMALL).collect()]
    check_packing(rows, library_ids(left))
