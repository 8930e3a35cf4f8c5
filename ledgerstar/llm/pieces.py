"""SentencePiece segmentation: the best ways to cut a text into pieces, and back to text.

A text is normalised as the model says: a space in front, spaces written as "▁". The pieces
that match anywhere in it form a lattice, a segmentation is a path, its score the sum of its
pieces' scores. No piece goes on past a "▁" that follows another character, so the lattice falls
into words at those places and each different word is solved once for a batch of texts.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from ledgerstar.llm.common import id_and_text, ready_workers

SPACE = "▁"
#: Scores are counted in this unit, so that sums are exact and equal scores are found equal.
UNIT = 1.0 / (1 << 16)
#: A character without a piece of its own scores so much less than the lowest piece.
UNKNOWN_PENALTY = 10.0
#: Characters of texts that are solved together.
BATCH_CHARS = 4_000_000


@dataclass
class PieceModel:
    """Pieces with scores, and a double-array trie over their characters."""

    texts: pa.BinaryArray  # of each id, a byte piece as its byte
    scores: dict[str, tuple[int, int]]  # of each ordinary piece: id, score in units
    byte_ids: list[int]
    unknown_id: int
    unknown_score: int
    classes: np.ndarray  # of each code point, 0 if no piece has it
    base: np.ndarray
    check: np.ndarray
    ids: np.ndarray  # of each trie state, -1 if no piece ends there
    units: np.ndarray  # score of each id
    longest: int  # characters of a piece

    @classmethod
    def load(cls, path: str) -> "PieceModel":
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        byte_ids = [i for i in range(size) if model.is_byte(i)]
        other = {i for i in range(size) if model.is_control(i) or model.is_unused(i)}
        other |= {*byte_ids, model.unk_id()}
        units = np.array([round(model.get_score(i) / UNIT) for i in range(size)], np.int64)
        plain = {names[i]: i for i in range(size) if i not in other}
        if any(SPACE in name.lstrip(SPACE) for name in plain):
            raise ValueError("pieces of this model cross word borders")
        if max(map(len, plain)) > 31:
            raise ValueError("a piece of this model has over 31 characters")
        texts = [name.encode() for name in names]
        for value, i in enumerate(byte_ids):
            texts[i] = bytes([value])
        lowest = min(int(units[i]) for i in plain.values())
        return cls(
            pa.array(texts, pa.binary()),
            {name: (i, int(units[i])) for name, i in plain.items()},
            byte_ids,
            model.unk_id(),
            lowest - round(UNKNOWN_PENALTY / UNIT),
            *_double_array(plain),
            units,
            max(map(len, plain)),
        )


def _double_array(pieces: dict[str, int]) -> tuple[np.ndarray, ...]:
    """Trie as arrays: from state s by class c to t = base[s] + c, if check[t] is s."""
    characters = sorted({c for p in pieces for c in p})
    number = {c: i + 1 for i, c in enumerate(characters)}
    classes = np.zeros(0x110000, np.int32)
    for character, value in number.items():
        classes[ord(character)] = value
    root: dict = {}
    for piece, piece_id in pieces.items():
        node = root
        for character in piece:
            node = node.setdefault(number[character], {})
        node[0] = piece_id  # class 0 is no character
    base, check, ids = [0], [-2], [-1]
    free, waiting = 1, [(0, root)]
    while waiting:
        state, node = waiting.pop()
        steps = sorted(c for c in node if c)
        if 0 in node:
            ids[state] = node[0]
        if not steps:
            continue
        offset = max(0, free - steps[0])
        while True:
            if (need := offset + steps[-1] + 1 - len(check)) > 0:
                base += [0] * need
                check += [-1] * need
                ids += [-1] * need
            if all(check[offset + c] == -1 for c in steps):
                break
            offset += 1
        base[state] = offset
        for c in steps:
            check[offset + c] = state
            waiting.append((offset + c, node[c]))
        while free < len(check) and check[free] != -1:
            free += 1
    size = len(characters) + 1  # room for a step from any state
    return (
        classes,
        np.array(base, np.int32),
        np.array(check + [-1] * size, np.int32),
        np.array(ids, np.int32),
    )


def word_keys(text: str) -> list[str]:
    """Words of the normalised text, each without the "▁" it begins with; none if empty."""
    if not text:
        return []
    keys = text.replace(" ", SPACE).split(SPACE)
    if "" not in keys:
        return keys
    found, spaces = [], 0
    for key in keys:
        if key:
            found.append(SPACE * spaces + key)
            spaces = 0
        else:
            spaces += 1
    if spaces:
        found.append(SPACE * (spaces - 1))
    return found


class Words:
    """Forward Viterbi over the lattices of many words at once.

    Nodes are the places between characters, a run of nodes per word. ``best`` of a node is the
    score of the best path from the word's start, the forward score that A* later takes as its
    heuristic. Of paths that tie, the one with the longer last piece counts as best.
    """

    def __init__(self, model: PieceModel, keys: list[str]):
        sizes = np.array([len(k) + 1 for k in keys], np.int64)
        joined = SPACE + SPACE.join(keys)
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = model.classes[code]
        ends = np.cumsum(sizes)
        first = ends - sizes  # of each word, in characters
        word = np.repeat(np.arange(len(keys)), sizes)
        stop = ends[word]

        starts, lengths, pieces = self._edges(model, kind, stop)
        # Character p of word w lies between nodes p + w and p + w + 1.
        begin = starts + word[starts]
        end = begin + lengths
        units = np.append(model.units, model.unknown_score)
        # A run so long that its score could pass 62 bits is counted in Python's integers.
        wide = int(np.abs(units).max()) * int(sizes.max()) >= 1 << 61
        score = units.astype(object if wide else np.int64)[pieces]
        at = end - (first + np.arange(len(keys)))[word[starts]]
        order = np.lexsort((end, at))
        begin, end, score, at = begin[order], end[order], score[order], at[order]
        lengths, pieces = lengths[order], pieces[order]

        nodes = len(code) + len(keys)
        best = np.zeros(nodes, score.dtype)
        taken = np.zeros(nodes, np.int64)  # length of the last piece
        steps = np.flatnonzero(np.diff(at, prepend=0))
        for a, b in zip(steps, [*steps[1:], len(at)]):
            value = best[begin[a:b]] + score[a:b]
            group = np.flatnonzero(np.diff(end[a:b], prepend=-1))
            top = np.maximum.reduceat(value, group)
            ties = value == np.repeat(top, np.diff(group, append=b - a))
            into = end[a:b][group]
            best[into] = top
            taken[into] = np.maximum.reduceat(np.where(ties, lengths[a:b], 0), group)
        piece_of = np.zeros(nodes, np.int64)
        chosen = lengths == taken[end]
        piece_of[end[chosen]] = pieces[chosen]

        heads = first + np.arange(len(keys))
        tails = heads + sizes
        on_path = np.zeros(nodes, bool)
        now, low = tails, heads
        while len(now):
            on_path[now] = True
            now = now - taken[now]
            going = now > low
            now, low = now[going], low[going]
        # The best detour of each word leaves its best path once.
        detour = on_path[end] & ~chosen
        loss = best[end[detour]] - best[begin[detour]] - score[detour]
        self.loss = np.full(len(keys), np.iinfo(np.int64).max, score.dtype)
        node_word = np.repeat(np.arange(len(keys)), sizes + 1)
        np.minimum.at(self.loss, node_word[end[detour]], loss)
        self.score = best[tails]
        path = np.flatnonzero(on_path)
        self.counts = np.bincount(node_word[path], minlength=len(keys))
        self.ids = self._bytes(model, code, path, piece_of, node_word)

    @staticmethod
    def _edges(model: PieceModel, kind: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
        """(start, length, piece or -1) of every piece that matches, by walking the trie."""
        start = np.arange(len(kind))
        state = np.zeros(len(kind), np.int64)
        found, single, length = [], np.zeros(len(kind), bool), 0
        while len(start):
            step = kind[start + length]
            after = model.base[state] + step
            there = (step > 0) & (model.check[after] == state)
            start, state = start[there], after[there]
            length += 1
            pieces = model.ids[state]
            ends = pieces >= 0
            found.append((start[ends], np.full(ends.sum(), length), pieces[ends]))
            if length == 1:
                single[start[ends]] = True
            inside = start + length < stop[start]
            start, state = start[inside], state[inside]
        alone = np.flatnonzero(~single)
        found.append((alone, np.ones(len(alone), np.int64), np.full(len(alone), -1)))
        return tuple(np.concatenate(x) for x in zip(*found))

    def _bytes(self, model, code, path, piece_of, node_word) -> list[bytes]:
        """Ids of each word's best path, as unsigned 32-bit integers."""
        ids = piece_of[path].astype("<u4")
        edges = np.concatenate([[0], np.cumsum(self.counts)])
        raw = ids.tobytes()
        found = [raw[4 * a : 4 * b] for a, b in zip(edges, edges[1:])]
        for word in set(node_word[path[piece_of[path] < 0]].tolist()):
            some = path[edges[word] : edges[word + 1]]
            parts = [
                spelled(model, chr(code[n - 1 - word])) if piece_of[n] < 0 else [int(piece_of[n])]
                for n in some
            ]
            found[word] = np.array([i for p in parts for i in p], "<u4").tobytes()
        self.counts = np.array([len(f) // 4 for f in found])
        return found


def spelled(model: PieceModel, character: str) -> list[int]:
    """A character without a piece: its UTF-8 bytes, or unknown if the model has no bytes."""
    if not model.byte_ids:
        return [model.unknown_id]
    return [model.byte_ids[b] for b in character.encode("utf-8", "surrogatepass")]


def n_best(model: PieceModel, words: list[str], n: int) -> list[tuple[int, list[list[int]]]]:
    """The ``n`` best segmentations of words in a row: score, and the ids of each word.

    Forward scores come first. Then A* goes back from the end: a hypothesis is a path from some
    node to the end, and its own score plus the forward score of the node is exactly the score
    of its best completion. So complete paths leave the heap in order of score.

    Of equal bounds the newest hypothesis goes first. One that is taken off has a successor of
    the same bound, so each path is complete after at most as many steps as there are characters,
    and the heap holds at most that many for each path and for each length of a piece, however
    many segmentations tie.
    """
    edges: list[list[tuple[int, int, list[int]]]] = [[]]  # into each node: from, score, ids
    borders = []
    for word in words:
        text, first = SPACE + word, len(edges) - 1
        for stop in range(1, len(text) + 1):
            into = []
            for start in range(max(0, stop - model.longest), stop):
                if found := model.scores.get(text[start:stop]):
                    into.append((first + start, found[1], [found[0]]))
            if text[stop - 1] not in model.scores:
                into.append((first + stop - 1, model.unknown_score, spelled(model, text[stop - 1])))
            edges.append(into)
        borders.append(first)
    forward = [0]
    for into in edges[1:]:
        forward.append(max(forward[a] + s for a, s, _ in into))
    heads = set(borders)
    last = len(edges) - 1
    # (-score of the best completion, newest first, node, own score, path)
    heap = [(-forward[last], 0, last, 0, None)]
    arrived, found = 0, []
    while heap and len(found) < n:
        bound, _, node, own, path = heapq.heappop(heap)
        if node == 0:
            split, rest = [], path
            while rest:
                begin, ids, rest = rest
                if begin in heads:
                    split.append([])
                split[-1] += ids
            found.append((-bound, split))
            continue
        # Long pieces last, so that ties come in the order of the best path.
        for begin, score, ids in reversed(edges[node]):
            arrived += 1
            total = own + score
            heapq.heappush(
                heap, (-(total + forward[begin]), -arrived, begin, total, (begin, ids, path))
            )
    return found


class Solver:
    """Best paths of words, kept for later texts up to ``most_words`` of them."""

    _of: dict[str, "Solver"] = {}

    def __init__(self, model: PieceModel, most_words: int = 500_000):
        self.model, self.most_words = model, most_words
        self._clear()

    @classmethod
    def of(cls, path: str, model: PieceModel) -> "Solver":
        """One per worker process, so that later tasks find the words of earlier ones."""
        if path not in cls._of:
            cls._of[path] = cls(model)
        return cls._of[path]

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.ids: list[bytes] = []
        self.score = self.loss = np.zeros(0, np.int64)

    def _learn(self, split: list[list[str]]) -> None:
        if len(self.number) > self.most_words:
            self._clear()
        new: set[str] = set()
        for some in split:
            new.update(some)
        if not (keys := list(new.difference(self.number))):
            return
        solved = Words(self.model, keys)
        self.number.update(zip(keys, range(len(self.ids), len(self.ids) + len(keys))))
        self.ids += solved.ids
        self.score = np.concatenate([self.score, solved.score])
        self.loss = np.concatenate([self.loss, solved.loss])

    def solve(self, texts: list[str], n: int) -> Iterator[list[tuple[int, bytes]]]:
        """The ``n`` best segmentations of each text: score in units, ids as 32-bit integers.

        Beyond the best, a text's segmentations need change only the ``n - 1`` words whose best
        detour costs least: those detours alone give as many that are at least as good as any
        that changes another word. So A* runs over these words, all others keep their best path.
        """
        split = [word_keys(t) for t in texts]
        self._learn(split)
        for some in split:
            if not some:
                yield [(0, b"")]
                continue
            at = np.fromiter(map(self.number.__getitem__, some), np.int64, len(some))
            ids = list(map(self.ids.__getitem__, at.tolist()))
            total = int(self.score[at].sum())
            found = [(total, b"".join(ids))]
            if n > 1:
                loss = self.loss[at]
                cheap = np.sort(np.argsort(loss, kind="stable")[: n - 1]).tolist()
                here = int(self.score[at[cheap]].sum())
                for score, parts in n_best(self.model, [some[i] for i in cheap], n + 1):
                    packed = [np.array(p, "<u4").tobytes() for p in parts]
                    if packed == [ids[i] for i in cheap]:
                        continue  # the best path, known already
                    changed = ids.copy()
                    for i, other in zip(cheap, packed):
                        changed[i] = other
                    found.append((total - here + score, b"".join(changed)))
            yield found[:n]


def decode_ids(model: PieceModel, ids: np.ndarray) -> str:
    """The text of ids: pieces in a row, without the space in front; damage becomes U+FFFD."""
    if not len(ids):
        return ""
    pieces = model.texts.take(pa.array(ids))
    # Pieces that were taken lie one after another.
    ends = np.frombuffer(pieces.buffers()[1], np.int32)
    raw = pieces.buffers()[2].to_pybytes()[ends[0] : ends[len(ids)]]
    return raw.decode("utf-8", "replace").replace(SPACE, " ").removeprefix(" ")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts in lists of about ``BATCH_CHARS`` characters."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            ids.append(doc_id)
            texts.append(text.as_py())
            size += len(texts[-1])
            if size >= BATCH_CHARS:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def encode(docs: DataFrame, model_path: str, n: int = 1) -> DataFrame:
    """``doc_id, rank, score, ids``: the ``n`` best segmentations of each text, best first.

    Fewer exist for short texts; an empty or null text has one, without pieces. Scores fall
    with rank; which of several equal ones come is settled by the order of the search. Repeated
    rows are encoded each. Only the model, whose size is fixed, goes to every task.
    """
    spark = docs.sparkSession
    ready_workers(spark)
    shared = spark.sparkContext.broadcast(PieceModel.load(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, texts in _texts(batches):
            solved = Solver.of(model_path, shared.value).solve(texts, n)
            for doc_id, found in zip(doc_ids, solved):
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array([doc_id] * len(found), pa.int64()),
                        "rank": pa.array(range(1, len(found) + 1), pa.int32()),
                        "score": pa.array([s * UNIT for s, _ in found]),
                        "ids": pa.array(
                            [np.frombuffer(i, "<i4") for _, i in found], pa.list_(pa.int32())
                        ),
                    }
                )

    schema = "doc_id bigint, rank int, score double, ids array<int>"
    return id_and_text(docs).mapInArrow(run, schema)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, rank, text`` of rows with ``doc_id, rank, ids``; null ids give an empty text."""
    spark = encoded.sparkSession
    ready_workers(spark)
    shared = spark.sparkContext.broadcast(PieceModel.load(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                decode_ids(shared.value, np.array(i.as_py() or [], np.int32))
                for i in batch.column("ids")
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("rank"), pa.array(texts, pa.string())],
                ["doc_id", "rank", "text"],
            )

    columns = encoded.select("doc_id", "rank", "ids")
    return columns.mapInArrow(run, "doc_id bigint, rank int, text string")


def round_trips(docs: DataFrame, model_path: str, n: int) -> DataFrame:
    """Encode and decode in one pass: a row per document with figures instead of the ids.

    ``doc_id, n_pieces, ids_crc32`` (of the best ids as little-endian unsigned 32-bit integers),
    ``same_text`` (all ``n`` segmentations decode to the text; a "▁" in it counts as a space)
    and ``scores``, best first.
    """
    spark = docs.sparkSession
    ready_workers(spark)
    shared = spark.sparkContext.broadcast(PieceModel.load(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, texts in _texts(batches):
            model, rows = shared.value, []
            solved = Solver.of(model_path, model).solve(texts, n)
            for doc_id, text, found in zip(doc_ids, texts, solved):
                plain = text.replace(SPACE, " ")
                same = all(
                    decode_ids(model, np.frombuffer(i, "<u4")) == plain for _, i in found
                )
                best = found[0][1]
                scores = [s * UNIT for s, _ in found]
                rows.append((doc_id, len(best) // 4, zlib.crc32(best), same, scores))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                ["doc_id", "n_pieces", "ids_crc32", "same_text", "scores"],
            )

    schema = (
        "doc_id bigint, n_pieces bigint, ids_crc32 bigint, same_text boolean, scores array<double>"
    )
    return id_and_text(docs).mapInArrow(run, schema)
