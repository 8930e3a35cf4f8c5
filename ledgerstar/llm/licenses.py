"""License notices in texts: an exact set-similarity join of text blocks with templates."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstar.llm.common import id_and_text, ready_workers

#: Share of a template's different words that a block must hold.
CONTAINMENT = 0.8
#: Templates that go to every task, at most.
MOST_TEMPLATES = 1_000

# Phrases whose words must stand one after another.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Wording of public license notices, by label.
NOTICES = {
    "mit-notice": "Released under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy "
    "of this software and associated documentation files, to deal in the Software without "
    "restriction",
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but "
    "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR "
    "A PARTICULAR PURPOSE.",
    "bsd-conditions": "Redistribution and use in source and binary forms, with or without "
    "modification, are permitted provided that the following conditions are met",
    "mpl-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, "
    "v. 2.0.",
    "cc-by-notice": "This work is licensed under a Creative Commons Attribution License",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
}

# Every byte that is no digit, letter or part of a character beyond ASCII parts words.
_WORD_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def words(text: str) -> list[bytes]:
    """Lower case A-Z, then the runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().translate(_WORD_BYTES).split()


@dataclass(frozen=True)
class Template:
    """A label and its words; ``phrase``: they must stand one after another."""

    label: str
    words: tuple[bytes, ...]
    phrase: bool
    containment: float

    @property
    def different(self) -> frozenset[bytes]:
        return frozenset(self.words)

    @property
    def overlap(self) -> int:
        """Different words that a block must share with the template."""
        return ceil(self.containment * len(self.different) - 1e-9)

    @property
    def width(self) -> int:
        """Words of a block: a phrase's own length, or a quarter more than a notice has."""
        return len(self.words) if self.phrase else len(self.words) + len(self.words) // 4


def templates(
    phrases: dict[str, str] = PHRASES,
    notices: dict[str, str] = NOTICES,
    containment: float = CONTAINMENT,
) -> list[Template]:
    found = [Template(label, tuple(words(p)), True, 1.0) for p, label in phrases.items()]
    found += [Template(label, tuple(words(n)), False, containment) for label, n in notices.items()]
    if len(found) > MOST_TEMPLATES:
        raise ValueError(f"more than {MOST_TEMPLATES} templates; scan for them in several runs")
    if any(not t.words for t in found):
        raise ValueError("a template has no word")
    return found


def word_counts(docs: DataFrame, scan: list[Template]) -> dict[bytes, int]:
    """How often each word of the templates occurs in all texts: one row per word."""
    vocabulary = frozenset(w for t in scan for w in t.words)
    ready_workers(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column("text"):
                found.update(filter(vocabulary.__contains__, words(text.as_py())))
        yield pa.RecordBatch.from_pydict(
            {
                "word": pa.array(list(found), pa.binary()),
                "n": pa.array(list(found.values()), pa.int64()),
            }
        )

    counted = id_and_text(docs).mapInArrow(count, "word binary, n bigint")
    rows = counted.groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {w: 0 for w in vocabulary} | {bytes(r["word"]): r["n"] for r in rows}


class Index:
    """Templates by the words of their prefixes, in global order from rare to frequent.

    A block that shares ``overlap`` words with a template has one of the template's
    ``size - overlap + 1`` rarest. So only blocks around such words are looked at.
    """

    def __init__(self, scan: list[Template], counts: dict[bytes, int]):
        self.scan = scan
        self.vocabulary = frozenset(counts)
        order = sorted(self.vocabulary, key=lambda w: (counts[w], w))
        self.rank = {w: at for at, w in enumerate(order)}
        # By word of a prefix: which templates have it there.
        self.prefixes: dict[bytes, list[int]] = {}
        for at, template in enumerate(scan):
            rare_first = sorted(template.different, key=self.rank.__getitem__)
            for word in rare_first[: len(rare_first) - template.overlap + 1]:
                self.prefixes.setdefault(word, []).append(at)
        self.keys = frozenset(self.prefixes)

    def matches(self, text_words: list[bytes]) -> list[tuple[int, int, int, float]]:
        """(template, first word, end, containment) of each place, in no order.

        A phrase gives each place where its words stand in a row. A notice gives every block that
        meets the threshold while no shorter block within it does: see ``_blocks``.
        """
        if self.keys.isdisjoint(text_words):
            return []
        places = [(at, w) for at, w in enumerate(text_words) if w in self.vocabulary]
        anchors: dict[int, list[tuple[int, int]]] = {}
        for index, (at, word) in enumerate(places):
            for template in self.prefixes.get(word, ()):
                t = self.scan[template]
                # Length filter: a text with fewer words than the overlap cannot hold it.
                if len(text_words) >= t.overlap and self._enough(t, index, places):
                    anchors.setdefault(template, []).append((index, at))
        found = []
        for template, around in anchors.items():
            t = self.scan[template]
            search = self._rows if t.phrase else self._blocks
            found += [(template, *m) for m in search(t, around, places, text_words)]
        return found

    def _enough(self, t: Template, index: int, places) -> bool:
        """Positional filter: can a block whose rarest shared word is this one reach the overlap?

        Then the words that it shares come at or after this one in the global order. Blocks
        that share a rarer word are reached from that.
        """
        at, word = places[index]
        least, shared = self.rank[word], {word}
        for step in (-1, 1):
            i = index + step
            while 0 <= i < len(places) and abs(places[i][0] - at) < t.width:
                if places[i][1] in t.different and self.rank[places[i][1]] >= least:
                    shared.add(places[i][1])
                i += step
            if len(shared) >= t.overlap:
                return True
        return False

    @staticmethod
    def _rows(t: Template, around, places, text_words) -> Iterator[tuple[int, int, float]]:
        seen = set()
        for _, at in around:
            offsets = [i for i, w in enumerate(t.words) if w == text_words[at]]
            for start in {at - i for i in offsets} - seen:
                seen.add(start)
                if start >= 0 and tuple(text_words[start : start + len(t.words)]) == t.words:
                    yield start, start + len(t.words), 1.0

    @staticmethod
    def _blocks(t: Template, around, places, text_words) -> Iterator[tuple[int, int, float]]:
        """All minimal blocks, by sliding over the template's words near the anchors.

        A block is minimal if it meets the threshold and loses that without its first or its last
        word. Each is returned by its start, with the greatest share that a block of at most
        ``width`` words has from there, and the end of the shortest such block. So of notices
        side by side each is found, whichever is the more complete.
        """
        near, last = [], -1
        for index, at in around:
            low = index
            while low > last + 1 and at - places[low - 1][0] < t.width:
                low -= 1
            high = index
            while high + 1 < len(places) and places[high + 1][0] - at < t.width:
                high += 1
            for i in range(max(low, last + 1), high + 1):
                if places[i][1] in t.different:
                    near.append(places[i])
            last = max(last, high)
        held: Counter[bytes] = Counter()
        begin = 0
        for end, (at, word) in enumerate(near):
            held[word] += 1
            while at - near[begin][0] >= t.width or (
                held[near[begin][1]] > 1 or len(held) > t.overlap
            ):
                gone = near[begin][1]
                held[gone] -= 1
                if not held[gone]:
                    del held[gone]
                begin += 1
            if len(held) == t.overlap and held[word] == 1:
                first, most, stop, seen = near[begin][0], 0, 0, set()
                for i in range(begin, len(near)):
                    if near[i][0] - first >= t.width:
                        break
                    seen.add(near[i][1])
                    if len(seen) > most:
                        most, stop = len(seen), near[i][0] + 1
                yield first, stop, most / len(t.different)


def scan_documents(docs: DataFrame, scan: list[Template] | None = None) -> DataFrame:
    """One row per document with all its matches: ``doc_id, n_words, matches``.

    ``matches`` is an array of (label, phrase, start, stop, containment), words counted from 0,
    by start, stop and label. A block is a run of up to ``width`` words anywhere in the text, so
    none is missed at a border, and every minimal one that meets the threshold is listed. The first pass counts the templates' words in all texts, the second
    joins each text with the prefix index; nothing is shuffled but those counts. Null and empty
    texts have no words; rows that repeat are scanned each.
    """
    ready_workers(docs.sparkSession)
    scan = templates() if scan is None else scan
    index = Index(scan, word_counts(docs, scan))
    match = pa.struct(
        [
            ("label", pa.string()),
            ("phrase", pa.bool_()),
            ("start", pa.int64()),
            ("stop", pa.int64()),
            ("containment", pa.float64()),
        ]
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, found = [], []
            for text in batch.column("text"):
                text_words = words(text.as_py())
                sizes.append(len(text_words))
                rows = [
                    {
                        "label": scan[t].label,
                        "phrase": scan[t].phrase,
                        "start": start,
                        "stop": stop,
                        "containment": share,
                    }
                    for t, start, stop, share in index.matches(text_words)
                ]
                found.append(sorted(rows, key=lambda r: (r["start"], r["stop"], r["label"])))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(found, pa.list_(match)),
                ],
                ["doc_id", "n_words", "matches"],
            )

    schema = (
        "doc_id bigint, n_words bigint, matches array<struct<label string, phrase boolean, "
        "start bigint, stop bigint, containment double>>"
    )
    return id_and_text(docs).mapInArrow(search, schema)
