"""Toxicity by a weighted grammar of small finite-state machines over the words of a clause."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from hashlib import sha256
from itertools import groupby
from math import exp, lgamma, log
from unicodedata import category

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstar.llm.common import id_and_text, in_set_share, ready_workers
from ledgerstar.session import materialize

#: Labelled rows that the lexicon and the weights are fitted on, at most.
SAMPLE_ROWS = 20_000
#: Characters of a word from which on the lexicon holds its SHA-256 instead.
LONG_WORD = 64
#: Lengths of the word beginnings that are tried as stems.
STEMS = (4, 5, 6)
#: Odds, before any count, that a word, a stem or a fixed insult speaks for toxicity.
WORD_ODDS, STEM_ODDS, INSULT_ODDS = 0.003, 1e-5, 1e3
#: Texts that the toxic share of a word which tells nothing is spread by.
SPREAD = 20
#: Remainder of crc32(id) by 4 that never trains.
HELD_OUT = 2
#: From this score on a document counts as toxic.
THRESHOLD = 0.3

# Words of the grammar in English, German, French and Spanish.
INSULTS = """
    idiot moron loser scum trash stupid pathetic worthless disgusting dumb fool jerk bastard
    imbecile dummkopf arschloch abschaum crétin connard salaud ordure imbécil estúpido basura
""".split()
THREATS = """
    kill hurt destroy smash stab strangle shoot töten umbringen verprügeln tuer frapper matar
    golpear
""".split()
TARGETS = """
    you your youre he she they them him her people du dich dir ihr euch sie tu toi vous vos tú
    usted ustedes ellos
""".split()
NEGATIONS = "not never no dont isnt arent nicht kein keine nie pas jamais nunca tampoco".split()
REPORTS = """
    said says called calls wrote writes claimed reported quoted sagte schrieb nannte dit écrit
    dijo escribió llamó
""".split()

_INSULTS = frozenset(INSULTS)
# A word goes on past combining marks, as decomposed accents and vowel signs are.
_MARK = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if category(c).startswith("M"))
_MARKED = re.compile(rf"[^\W_]+(?:[{_MARK}]+[^\W_]*)*|[.!?;:,\n]")
# The same for texts without characters from the first combining mark on, and much faster.
_PLAIN = re.compile(r"[^\W_]+|[.!?;:,\n]")
_BEYOND = re.compile(f"[{_MARK[0]}-{chr(sys.maxunicode)}]")
_CLAUSE_ENDS = frozenset(".!?;:,\n")

# What a clause may hold, and how far each speaks for toxicity before any label is seen.
EVENTS = ("insult", "targeted", "negated", "reported", "threat", "mild_threat")
_PRIOR = np.array([-4.0, 2.5, 3.0, 1.0, 1.0, 3.0, 0.5])


@dataclass(frozen=True)
class Machine:
    """A deterministic transducer: ``step(state, symbol)`` gives the next state and a mark."""

    start: int
    step: dict[tuple[int, str], tuple[int, bool]]


#: Symbols: insult, threat, target, negation, report, any other word.
SYMBOLS = "itpnro"


def _countdown(symbol: str, reach: int) -> Machine:
    """Marks words that follow ``symbol`` by at most ``reach`` words."""
    return Machine(
        0,
        {
            (left, s): (reach if s == symbol else max(0, left - 1), left > 0)
            for left in range(reach + 1)
            for s in SYMBOLS
        },
    )


def _since(symbol: str) -> Machine:
    """Marks every word after ``symbol`` to the end of the clause."""
    return Machine(0, {(q, s): (int(q or s == symbol), bool(q)) for q in (0, 1) for s in SYMBOLS})


def _marks(symbol: str) -> Machine:
    return Machine(0, {(0, s): (0, s == symbol) for s in SYMBOLS})


def compose(machines: list[Machine]) -> tuple[dict, dict]:
    """One machine that runs all in step: next states, and the marks that each step sets."""
    start = tuple(m.start for m in machines)
    number, waiting = {start: 0}, [start]
    step, marks = {}, {}
    while waiting:
        state = waiting.pop()
        for symbol in SYMBOLS:
            moves = [m.step[q, symbol] for m, q in zip(machines, state)]
            after = tuple(q for q, _ in moves)
            if after not in number:
                number[after] = len(number)
                waiting.append(after)
            step[number[state], symbol] = number[after]
            marks[number[state], symbol] = tuple(mark for _, mark in moves)
    return step, marks


# Insult, threat before, target before, target, negation before, report before.
_STEP, _MARKS = compose(
    [
        _marks("i"),
        _countdown("t", 4),
        _countdown("p", 4),
        _marks("p"),
        _countdown("n", 3),
        _since("r"),
    ]
)


def clause_events(symbols: str) -> list[str]:
    """The events of a clause, each word once: an insult, or a target after a threat."""
    events, state = [], 0
    for symbol in symbols:
        insult, threat, near_target, target, negated, reported = _MARKS[state, symbol]
        state = _STEP[state, symbol]
        if insult:
            kind = "negated" if negated else "reported" if reported else None
            events.append(kind or ("targeted" if near_target else "insult"))
        elif threat and target:
            events.append("mild_threat" if negated or reported else "threat")
    return events


@dataclass
class Grammar:
    """Lexicon with weights, and the weights of the events; every task has it.

    A word of the grammar keeps its part there and is never an insult.
    """

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: _PRIOR.copy())

    def __post_init__(self):
        self.fixed = {
            w: s
            for s, some in (("r", REPORTS), ("n", NEGATIONS), ("p", TARGETS), ("t", THREATS))
            for w in some
        }
        self.heads = {s[: STEMS[0]] for s in self.stems}

    def insult(self, word: str) -> float:
        """Weight of a word or of its longest stem, 0 if it is no insult."""
        key = _key(word)
        if key in self.words:
            return self.words[key]
        return next((self.stems[word[:n]] for n in STEMS[::-1] if word[:n] in self.stems), 0.0)

    def features(self, text: str) -> np.ndarray:
        """A constant, then how often each event occurs, insults by their weights, damped.

        A weight counts by its cube, so that in long texts many weak words stay below one strong.
        """
        totals = np.zeros(len(EVENTS) + 1)
        totals[0] = 1
        found = tokens(text)
        different = set(found)
        heads, n = self.heads, STEMS[0]
        insults = {
            w: weight
            for w in different
            if w not in self.fixed
            and (w in self.words or w[:n] in heads or len(w) >= LONG_WORD)
            and (weight := self.insult(w))
        }
        notable = different.intersection(THREATS).union(insults)
        if not notable:
            return totals
        counts = dict.fromkeys(EVENTS, 0.0)
        for ends, clause in groupby(found, _CLAUSE_ENDS.__contains__):
            words = list(clause)
            if ends or notable.isdisjoint(words):
                continue
            symbols = "".join("i" if w in insults else self.fixed.get(w, "o") for w in words)
            weights = iter([insults[w] for w in words if w in insults])
            for event in clause_events(symbols):
                threat = event in ("threat", "mild_threat")
                counts[event] += 1.0 if threat else (next(weights) / 4) ** 3
        totals[1:] = np.log1p(list(counts.values()))
        return totals

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.features(text) @ self.weights, -30, 30))))


def _training_rows(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """``text, toxic, n`` of at most ``rows`` labelled documents, chosen by a hash of the id.

    Rows that repeat an id together with its text are one document, ``n`` rows of it.
    """
    share = in_set_share(F.col("doc_id"))
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "toxic")
    known = known.filter(F.col("toxic").isin(0, 1) & (share != HELD_OUT))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # At most ``rows`` pairs of numbers go to the tasks.
    found = id_and_text(docs).join(F.broadcast(known), "doc_id")
    found = found.groupBy("doc_id", F.sha2("text", 256).alias("digest")).agg(
        F.max("text").alias("text"), F.max("toxic").alias("toxic"), F.count(F.lit(1)).alias("n")
    )
    found = materialize(found, "labelled_texts")
    first = found.select("doc_id", "digest").orderBy(F.xxhash64("doc_id"), "doc_id", "digest")
    found = found.join(F.broadcast(first.limit(rows)), ["doc_id", "digest"], "left_semi")
    return found.select("text", "toxic", "n")


def tokens(text: str) -> list[str]:
    """Words in lower case, and the marks that end clauses; learning and scoring share it."""
    lower = text.lower()
    return (_MARKED if _BEYOND.search(lower) else _PLAIN).findall(lower)


def _key(word: str) -> str:
    return sha256(word.encode()).hexdigest() if len(word) >= LONG_WORD else word


def forms(text: str) -> set[str]:
    """The different words of over two characters, and the beginnings that count as stems."""
    words = {w for w in tokens(text) if len(w) > 2}
    return {_key(w) for w in words} | {f"{w[:n]}*" for n in STEMS for w in words if len(w) > n}


@lru_cache(1 << 20)
def _weight(a: int, b: int, share: float, odds: float) -> float:
    """Log-odds of a form in ``a`` toxic and ``b`` clean texts, times the chance that it tells.

    Of the texts that hold a form, ``share`` are toxic if it tells nothing, and five in six by
    expectation if it does; Bayes' rule weighs the two. So no count is too small and no form too
    impure to enter, but one that chance explains as well weighs next to nothing.
    """

    def likely(toxic: float, clean: float) -> float:
        return sum(
            sign * (lgamma(toxic + x) + lgamma(clean + y) - lgamma(toxic + clean + x + y))
            for sign, x, y in ((1, a, b), (-1, 0, 0))
        )

    telling = log(odds) + likely(1.0, 0.2) - likely(SPREAD * share, SPREAD * (1 - share))
    chance = 1 / (1 + exp(-max(-700.0, min(700.0, telling))))
    return chance * max(0.0, log((a + 1.0) / (b + 0.2)) - log(share / (1 - share)))


@dataclass
class Counts:
    """In how many different texts, toxic and clean, each form of toxic texts occurs."""

    forms: list[tuple[str, int, int]] = field(default_factory=list)
    toxic: int = 0
    texts: int = 0

    def lexicon(self, without: int | None = None) -> tuple[dict[str, float], dict[str, float]]:
        """Weights of words and stems; a text ``without`` whose own label's count they are.

        A text of the sample must be judged by the others: its own rare words tell its label.
        """
        words, stems = {w: 4.0 for w in INSULTS}, {}
        if not 0 < self.toxic < self.texts:
            return words, stems
        share = self.toxic / self.texts
        for form, a, b in self.forms:
            a, b = max(0, a - (without == 1)), max(0, b - (without == 0))
            if form.endswith("*"):
                stems[form[:-1]] = _weight(a, b, share, STEM_ODDS)
            else:
                odds = INSULT_ODDS if form in _INSULTS else WORD_ODDS
                words[form] = _weight(a, b, share, odds)
        # A stem counts beyond the words that are known by themselves.
        return words, stems


def _counts(sample: DataFrame) -> Counts:
    """Count the words and stems of toxic texts.

    Copies of a text would make all its words look telling, so each different text counts once.
    """
    sample = sample.groupBy(F.sha2("text", 256).alias("digest")).agg(
        F.max("toxic").alias("toxic"), F.max("text").alias("text")
    )
    totals = sample.agg(F.count(F.lit(1)).alias("all"), F.sum("toxic").alias("toxic")).first()
    n, n1 = totals["all"], totals["toxic"] or 0
    if not 0 < n1 < n:
        return Counts()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, toxic in zip(batch.column("text"), batch.column("toxic")):
                found = sorted(forms(text.as_py()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([toxic.as_py()] * len(found), pa.int32()), pa.array(found, pa.string())],
                    ["toxic", "form"],
                )

    seen = sample.select("toxic", "text").mapInArrow(split, "toxic int, form string")
    seen = seen.groupBy("form").agg(
        F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")
    )
    seen = seen.filter("a > 0")
    return Counts([(r["form"], r["a"], r["b"]) for r in seen.collect()], n1, n)


def _fit(x: np.ndarray, y: np.ndarray, n: np.ndarray, steps: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps, drawn towards the weights that hold before data.

    Row i of ``x`` and ``y`` counts ``n[i]`` times.
    """
    weights, pull = _PRIOR.copy(), 0.5
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (n * (p - y)) + pull * (weights - _PRIOR)
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + pull * np.eye(len(weights))
        move = np.linalg.solve(curve, gradient)
        weights -= move * min(1.0, 2.0 / max(1e-9, np.abs(move).max()))
        if np.abs(move).max() < 1e-8:
            break
    return weights


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Grammar:
    """Learn the lexicon and the events' weights from labelled documents.

    Only rows of ``labels`` (``doc_id, toxic``) whose crc32(doc_id) mod 4 is not 2 are used, at
    most ``rows`` of them. The driver gets counts of words and each row's event counts, never
    texts. Without toxic labels the fixed words and the prior weights stand.
    """
    ready_workers(docs.sparkSession)
    sample = materialize(_training_rows(docs, labels, rows), "labelled")
    counts = _counts(sample)
    grammar = Grammar(*counts.lexicon())
    others = [Grammar(*counts.lexicon(without)) for without in (0, 1)]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [
                others[toxic.as_py()].features(text.as_py()).tolist()
                for text, toxic in zip(batch.column("text"), batch.column("toxic"))
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x), batch.column("toxic"), batch.column("n")], ["x", "toxic", "n"]
            )

    seen = sample.mapInArrow(measure, "x array<double>, toxic int, n bigint")
    # Most rows have no event; equal rows go to the driver as one.
    measured = seen.groupBy("x", "toxic").agg(F.sum("n").alias("n")).collect()
    if measured:
        order = sorted((r["x"], r["toxic"], r["n"]) for r in measured)
        x, y, n = (np.array(column, float) for column in zip(*order))
        if 0 < y.sum() < len(y):
            grammar.weights = _fit(x, y, n)
    return grammar


def clean(docs: DataFrame, grammar: Grammar, text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that score below the threshold."""
    ready_workers(docs.sparkSession)

    @F.arrow_udf("double")
    def rate(texts: pa.Array) -> pa.Array:
        return pa.array([grammar.score(t.as_py()) for t in texts], pa.float64())

    return docs.filter(rate(F.coalesce(F.col(text_column), F.lit(""))) < THRESHOLD)


def score(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document, from its whole text alone.

    Null and empty texts have no clause and the grammar's lowest score. Rows are independent,
    so copies and repeated rows score alike; a null id is not held out.
    """
    ready_workers(docs.sparkSession)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [grammar.score(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"]
            )

    held_out = F.coalesce(in_set_share(F.col("doc_id")) == HELD_OUT, F.lit(False))
    return (
        id_and_text(docs)
        .mapInArrow(rate, "doc_id bigint, score double")
        .select(
            "doc_id",
            held_out.alias("held_out"),
            "score",
            (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        )
    )
