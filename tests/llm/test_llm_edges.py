"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerstar.llm import (
    chat,
    components,
    exact,
    lexical,
    licenses,
    ngrams,
    packing,
    pieces,
    pivots,
    records,
    simhash,
    toxicity,
    vafile,
    warc,
)
from ledgerstar.llm.queries import BYTE_BPE, PIECE_BPE
from ledgerstar.session import scratch_path

LONG = "The word of the day. " * 40_000
#: Columns with the names of results, repeated rows, a null id, null and empty texts.
DOCS = [
    (1, "b text", "x", 5, True),
    (2, None, None, None, None),
    (3, "", "x", 5, True),
    (4, LONG, "x", 5, True),
    (5, "b text", "x", 5, True),
    (5, "b text", "x", 5, True),
    (None, "of nobody", None, None, None),
    (None, None, None, None, None),
]
SCHEMA = "doc_id long, text string, fingerprint string, start long, kept boolean"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(DOCS, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_segmentation(odd, empty):
    found = pieces.encode(odd, PIECE_BPE, n=2)
    texts = pieces.decode(found, PIECE_BPE).collect()
    assert {r["text"] for r in texts if r["doc_id"] == 4} == {LONG}
    assert sorted(r["text"] for r in texts if r["doc_id"] in (2, 3)) == ["", ""]
    assert len([r for r in texts if r["doc_id"] == 5]) == 4
    assert pieces.encode(empty, PIECE_BPE, n=2).count() == 0
    assert pieces.round_trips(odd, PIECE_BPE, 3).filter("same_text").count() == len(DOCS)


def test_licenses(spark, odd, empty):
    found = {r["doc_id"]: r for r in licenses.scan_documents(odd).collect()}
    assert found[2]["n_words"] == found[3]["n_words"] == 0 and found[4]["n_words"] == 200_000
    assert licenses.scan_documents(empty).count() == 0
    text = "x " * 500 + "The MIT\nLicense; licensed under CC BY NC 4 0 mit license" + " y" * 500
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    [row] = licenses.scan_documents(docs).collect()
    assert [(m["label"], m["start"]) for m in row["matches"] if m["phrase"]] == [
        ("mit", 501), ("mit", 510),
    ]
    assert "cc-by-nc-notice" in {m["label"] for m in row["matches"]}


def test_chat(spark):
    schema = "conv_id long, turn long, role string, text string, part int"
    turns = [
        (1, 0, "system", "Be kind", 7),
        (1, 1, "ann", "hi", None),
        (1, 2, "bob|x", "yes <|end|>", 7),
        (1, 2, "ann", None, 7),
        (1, None, None, "first", 7),
        (2, 0, "system", "alone", 7),
        (None, 0, "ann", "no id", 7),
        (None, 0, "ann", "no id", 7),
    ]
    found = chat.perspectives(spark.createDataFrame(turns, schema)).collect()
    by = {(r["conv_id"], r["speaker"]): r for r in found}
    assert set(by) == {(1, "ann"), (1, "bob|x"), (1, None), (None, "ann")}
    ann = by[1, "ann"]
    assert ann["text"] == (
        "<|user name=_none|>\nfirst<|end|>\n<|system|>\nBe kind<|end|>\n"
        "<|assistant|>\nhi<|end|>\n<|assistant|>\n<|end|>\n"
        "<|user name=bob_px|>\nyes < |end|><|end|>\n"
    )
    assert [ann["text"][s["start"] : s["end"]] for s in ann["spans"]] == [
        "hi<|end|>\n", "<|end|>\n",
    ]
    assert by[None, "ann"]["n_turns"] == 2
    assert chat.perspectives(spark.createDataFrame([], schema)).count() == 0


def test_like_names_are_different_speakers(spark):
    roles = ["a|b", "a_b", "a_pb", None, "unknown", "_none", "a\nb", "a\rb", ""]
    turns = [(1, t, role, f"say {t}", "x", 3) for t, role in enumerate(roles)]
    frame = spark.createDataFrame(
        turns, "conv_id long, turn long, role string, text string, speaker string, name int"
    )
    found = chat.perspectives(frame).collect()
    assert {r["speaker"] for r in found} == set(roles) and len(found) == len(roles)
    for r in found:
        at = roles.index(r["speaker"])
        assert [r["text"][s["start"] : s["end"]] for s in r["spans"]] == [f"say {at}<|end|>\n"]
        headers = [x for x in r["text"].split("\n") if x.startswith("<|")]
        assert len(set(headers)) == len(roles) and "<|assistant|>" in headers


def test_long_dialogue_comes_in_parts(spark):
    turns = [(7, t, "ann" if t % 2 else "bob", f"say {t}") for t in range(10_000)]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    found = chat.perspectives(frame).filter("speaker = 'ann'").orderBy("part").collect()
    assert [r["part"] for r in found] == list(range(157))
    assert [r["first_turn"] for r in found] == list(range(0, 10_000, 64))
    whole = "".join(r["text"] for r in found)
    assert whole.count("<|assistant|>") == 5_000 and whole.startswith("<|user name=bob|>\nsay 0<")


def test_records(spark, odd, empty):
    index = records.write_records(odd, scratch_path(spark, "r"), BYTE_BPE, parts=3)
    found = records.read_records(index).collect()
    assert len(found) == len(DOCS)
    assert [r["doc_id"] for r in sorted(found, key=lambda r: r["start"])] == [
        None, None, 1, 2, 3, 4, 5, 5,
    ]
    shuffled = records.read_shuffled(index, seed=3).collect()
    assert sorted(len(r["ids"]) for r in shuffled) == sorted(r["n_tokens"] for r in found)
    assert [r["ids"] for r in shuffled if r["doc_id"] == 3] == [[0]]
    index = records.write_records(empty, scratch_path(spark, "r"), BYTE_BPE)
    assert records.read_records(index).count() == 0


def test_damaged_records_are_refused():
    framed = b"".join(records.frames([b"abcdef", b"", b"x" * 1000]))
    assert list(records.unframe(pa.BufferReader(framed))) == [b"abcdef", b"", b"x" * 1000]
    for at in (0, 9, 13, len(framed) - 2):
        bad = bytearray(framed)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            list(records.unframe(pa.BufferReader(bytes(bad))))
    with pytest.raises(ValueError):
        list(records.unframe(pa.BufferReader(framed[:-1])))


def test_pivots(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 1), (1, [1.0, 2.0], 2), (2, [1.0, 2.0], 3), (3, None, 4),
        (4, [nan, 1.0], 5), (5, [None, 1.0], 6), (50, [inf, 0.0], 7), (100, [-1.0, 0.5], 8),
        (None, [9.0, 9.0], 9), (150, [1.0], 10), (200, [], 11), (6, [1.0, 2.0], 12),
        (6, [1.0, 2.0], 13),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    found = pivots.top_products(pivots.whole_vectors(vectors), F.col("vec_id") % 50 == 0, top=3)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found.collect())
    full = 256 * 256 * 5
    assert got == [
        (0, 1, 1, full), (0, 2, 2, full), (0, 3, 6, full),
        (100, 1, 0, 0), (100, 2, 1, 0), (100, 3, 2, 0),
    ]
    nothing = pivots.whole_vectors(vectors.limit(0))
    assert pivots.top_products(nothing, F.col("vec_id") % 50 == 0).count() == 0


def test_pivots_equal_brute_force_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(pivots, "CANDIDATES", 50)
    monkeypatch.setattr(pivots, "QUERIES", 7)
    random = np.random.default_rng(5)
    values = np.floor(random.normal(size=(900, 8)) * 20)
    values[300:600] = values[7]  # a third of all rows are one vector
    frame = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(values)], "vec_id long, vector array<double>"
    )
    found = pivots.top_products(frame, F.col("vec_id") % 50 == 0, top=5, sample=20).collect()
    wanted = []
    for q in range(0, 900, 50):
        scores = values @ values[q]
        best = sorted((-scores[i], i) for i in range(900) if i != q)[:5]
        wanted += [(q, rank, i, int(-s)) for rank, (s, i) in enumerate(best, 1)]
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found)
    assert got == sorted(wanted)


def test_pivots_send_no_block_to_the_driver(spark, monkeypatch):
    monkeypatch.setattr(pivots, "CANDIDATES", 16)
    monkeypatch.setattr(pivots, "QUERIES", 3)
    random = np.random.default_rng(6)
    values = np.floor(random.normal(size=(400, 4)) * 9)
    rows = [(i // 2, v.tolist()) for i, v in enumerate(values)]  # every id twice
    rows += [(1000 + i, [float(i), 1.0]) for i in range(40)]  # and another length
    frame = spark.createDataFrame(rows, "vec_id long, vector array<double>").repartition(3)
    asked = F.col("vec_id") % 10 == 0
    wanted = []
    for i, x in rows:
        if i % 10 == 0:
            others = [(-np.dot(x, y), j) for j, y in rows if j != i and len(x) == len(y)]
            wanted += [(i, n, j, int(-s)) for n, (s, j) in enumerate(sorted(others)[:5], 1)]
    for share in (8, 1 << 14):  # groups of several blocks, and of one
        monkeypatch.setattr(pivots, "SHARE", share, raising=False)
        found = pivots.top_products(frame, asked, top=5, sample=20)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "Generate" not in plan
        got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found.collect())
        assert got == sorted(wanted)


def test_toxicity(spark, odd, empty):
    labels = spark.createDataFrame(
        [(1, 0, 1), (4, 0, 0), (5, 0, None), (None, 0, 1), (1, 0, 1)],
        "doc_id long, quality int, toxic int",
    )
    grammar = toxicity.fit(odd, labels)
    found = toxicity.score(odd, grammar)
    assert found.count() == len(DOCS)
    assert found.filter("score is null or predicted is null or held_out is null").count() == 0
    assert toxicity.score(empty, toxicity.fit(empty, labels.limit(0))).count() == 0
    assert toxicity.clean(odd, toxicity.Grammar()).columns == odd.columns


def test_grammar_scores_clauses_not_words():
    words = {w: 4.0 for w in toxicity.INSULTS}
    grammar = toxicity.Grammar(words, {"lowei": 4.0})
    plain, aimed = grammar.score("an idiot there"), grammar.score("you idiot")
    assert aimed > plain > grammar.score("he said idiot") >= grammar.score("")
    assert plain > grammar.score("she is not an idiot")
    assert grammar.score("he will kill you") > grammar.score("never kill you")
    assert grammar.score("he will kill. you") == grammar.score("")
    assert grammar.score("x loweiung") > grammar.score("x lowe")
    assert toxicity.clause_events("pioni") == ["targeted", "negated"]
    assert toxicity.clause_events("toop") == ["threat"]


def test_toxicity_learns_words_and_stems(spark):
    docs, labels = [], []
    for i in range(600):
        bad = i % 6 == 0
        telling = f"zorkle schnabium{'abcdef'[i % 5]}" if bad else "and"
        docs.append((i, f"some clean words here {telling} {i}"))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    grammar = toxicity.fit(docs, labels)
    assert "zorkle" in grammar.words and "schna" in grammar.stems
    found = toxicity.score(docs, grammar).join(labels, "doc_id").filter("held_out").collect()
    assert all(r["predicted"] == r["toxic"] for r in found) and len(found) > 100


def test_toxicity_recall_on_held_out_rows(spark):
    """Rare and impure words of other languages tell as well; 99 of 120 without them."""
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    docs = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    found = toxicity.score(docs, toxicity.fit(docs, labels)).filter("held_out")
    found = found.join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()
    found = {(r["toxic"], r["predicted"]): r["count"] for r in found}
    assert found[1, 1] >= 108 and found[1, 1] + found[1, 0] == 120
    assert found.get((0, 1), 0) <= 5


def test_toxicity_learns_long_words(spark):
    telling = "zork" * 30
    docs = [(i, f"some words {telling if i % 6 == 0 else 'zork' * 29}") for i in range(600)]
    labels = [(i, int(i % 6 == 0)) for i in range(600)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    # Each different text counts once, so they are made to differ.
    docs = docs.withColumn("text", F.concat("text", F.lit(" "), F.col("doc_id")))
    grammar = toxicity.fit(docs, labels)
    assert grammar.insult(telling) > 4 > 1 > grammar.insult("zork" * 29)


def test_toxicity_bounds_rows_of_one_id(spark, rows):
    texts = [(1, "same text")] * 50 + [(1, f"text {i}") for i in range(20)]
    docs = rows("doc_id long, text string", *texts)
    labels = rows("doc_id long, toxic int", (1, 1))
    assert toxicity._training_rows(docs, labels, 5).count() == 5
    found = toxicity._training_rows(docs, labels, 100).collect()
    assert len(found) == 21 and sum(r["n"] for r in found) == 70


def test_exact(spark, odd, empty):
    found = exact.exact_duplicates(odd).collect()
    assert len(found) == len(DOCS)
    by = {(r["doc_id"], r["text_sha256"]): r for r in found}
    one = next(r for r in found if r["doc_id"] == 1)
    assert (one["keep_id"], one["group_size"], one["kept"]) == (5, 3, False)
    blank = [r for r in found if r["text_sha256"].startswith("e3b0c442")]
    assert sorted((r["doc_id"] or 0, r["keep_id"], r["kept"]) for r in blank) == [
        (0, 3, False), (2, 3, False), (3, 3, True),
    ]
    assert len(by) == 7 and exact.exact_duplicates(empty).count() == 0


def test_digest_index_keeps_earlier_batches(spark, rows):
    schema = "doc_id long, text string"
    index = exact.DigestIndex(spark, "digests_of_two_batches", buckets=4)
    exact.exact_duplicates(rows(schema, (1, "a"), (2, "a"), (3, "b")), index).collect()
    second = exact.exact_duplicates(rows(schema, (9, "a"), (8, "c"), (7, "c")), index).collect()
    assert sorted((r["doc_id"], r["keep_id"], r["kept"]) for r in second) == [
        (7, 8, False), (8, 8, True), (9, 2, False),
    ]
    assert index.read().count() == 3
    index.add(exact.digests(rows(schema, (9, "a"), (8, "c"))))
    assert index.read().count() == 3
    again = exact.exact_duplicates(rows(schema, (2, "a"), (2, "a")), index).collect()
    assert [(r["keep_id"], r["kept"]) for r in again] == [(2, False)] * 2
    plan = index.read().alias("a").join(index.read().alias("b"), "text_sha256")
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString().replace(
        "BroadcastExchange", ""
    )
    spark.sql("drop table digests_of_two_batches")


def test_two_batches_leave_no_table(spark, rows):
    before = {t.name for t in spark.catalog.listTables()}
    values = [(i, "abc"[i % 3]) for i in range(20)] + [(None, "a"), (None, "z"), (19, "b")]
    found = exact.exact_duplicates(rows("doc_id long, text string", *values)).collect()
    assert {t.name for t in spark.catalog.listTables()} == before
    largest = {t: max((i for i, x in values if x == t and i is not None), default=None) for t in "abcz"}
    sizes = {t: sum(x == t for _, x in values) for t in "abcz"}
    wanted = [(i, largest[t], sizes[t], i == largest[t]) for i, t in values]
    got = [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in found]
    assert sorted(got, key=str) == sorted(wanted, key=str)


def test_simhash(spark, odd, empty):
    found = simhash.near_duplicates(odd).collect()
    assert len(found) == len(DOCS)
    zero = {r["component_id"] for r in found if r["fingerprint"] == "0" * 16}
    assert zero == {2}
    assert {r["component_id"] for r in found if r["doc_id"] in (1, 5)} == {1}
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("leaf", [4, 64])
def test_links_of_dense_and_sparse_codes(spark, leaf):
    """A third of the codes lie in one ball, so that nodes have to be cut several times."""
    random = np.random.default_rng(leaf)
    codes = set(random.integers(0, 1 << 63, 400, dtype=np.uint64).tolist())
    center = int(random.integers(0, 1 << 63, dtype=np.uint64))
    for _ in range(200):
        flips = random.choice(64, size=random.integers(0, 6), replace=False)
        codes.add(center ^ sum(1 << int(f) for f in flips))
    for code in list(codes)[:100]:
        codes.add(code ^ (1 << int(random.integers(64))) ^ (1 << int(random.integers(64))))
    codes = sorted(codes)
    signed = [c - (1 << 64) if c >= 1 << 63 else c for c in codes]
    frame = spark.createDataFrame([(c,) for c in signed], "code long")
    links = simhash.close_links(frame, bits=2, leaf=leaf)
    named = {r["node"]: r["component"] for r in components.components(links).collect()}
    label = list(range(len(codes)))
    array = np.array(codes, np.uint64)

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(codes)):
        for j in np.flatnonzero(np.bitwise_count(array ^ array[i]) <= 2):
            label[root(i)] = root(int(j))
    groups, wanted = {}, {}
    for i, code in enumerate(signed):
        wanted.setdefault(root(i), set()).add(code)
        groups.setdefault(named.get(code, code), set()).add(code)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1002), (5, 5), (1001, 1000)]
    found = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r["node"], r["component"]) for r in found} == {(i, 0) for i in range(1, 201)} | {
        (1001, 1000), (1002, 1000),
    }


def test_packing(spark, odd, empty):
    found = packing.pack_documents(odd, BYTE_BPE)
    rows = found.collect()
    assert len([r for r in rows if r["doc_id"] == 5]) == 2
    assert [r["length"] for r in rows if r["doc_id"] == 3] == [1]
    assert packing.pack_documents(empty, BYTE_BPE).count() == 0
    own = odd.filter("doc_id < 5")
    packed = packing.pack_documents(own, BYTE_BPE)
    made = packing.sequences(own, packed.cache(), BYTE_BPE).collect()
    assert sum(len(r["ids"]) for r in made) == packed.agg(F.sum("length")).first()[0]


def test_packing_of_many_rounds(spark, monkeypatch):
    monkeypatch.setattr(packing, "MOST_ITEMS", 40)
    random = np.random.default_rng(1)
    sizes = random.integers(1, 100, 2000).tolist()
    items = spark.createDataFrame(list(enumerate(sizes)), "item long, length long").repartition(16)
    placed = packing.pack(items, capacity=100).collect()
    assert sorted(r["item"] for r in placed) == list(range(2000))
    fill = {}
    for r in sorted(placed, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == fill.get(r["sequence_id"], 0)
        fill[r["sequence_id"]] = r["offset"] + sizes[r["item"]]
    assert max(fill.values()) <= 100 and len(fill) <= 1.1 * -(-sum(sizes) // 100)


def test_best_fit_takes_the_tightest_space():
    bins = packing.best_fit([(60, [1], [0]), (50, [2], [0]), (40, [3], [0]), (45, [4], [0])], 100)
    assert sorted((f, sorted(m)) for f, m, _ in bins) == [(95, [2, 4]), (100, [1, 3])]


def test_archives(spark):
    pages = spark.createDataFrame(
        [
            (1, "http://www.A.org:80/x?q=1#f", "same\r\n\r\nWARC/1.1", "z"),
            (2, "https://b.org/ü\r\nX: y", "same\r\n\r\nWARC/1.1", "z"),
            (3, None, None, "z"),
            (4, "", "", None),
            (4, "", "", None),
            (None, "http://[bad", "é" * 3_000_000, "z"),
        ],
        "page_id long, url string, html string, keep_id string",
    )
    runs = warc.write_archives(pages, scratch_path(spark, "w"))
    found = sorted(
        ((r["page_id"] or 0, r["payload_bytes"], r["record_type"], r["refers_to"]) 
         for r in warc.read_archives(runs).collect()),
        key=str,
    )
    assert found == sorted(
        [
            (1, 16, "revisit", 2), (2, 16, "response", None), (3, 0, "revisit", 4),
            (4, 0, "response", None), (4, 0, "response", None), (0, 6_000_000, "response", None),
        ],
        key=str,
    )
    merged = warc.merge_runs(runs).orderBy("place").collect()
    keys = [(r["url_key"], r["time"]) for r in merged]
    assert keys == sorted(keys) and len(keys) == 6
    assert warc.url_key("http://www.A.org:80/x?q=1#f") == "org,a)/x?q=1"
    none = warc.write_archives(pages.limit(0), scratch_path(spark, "w"))
    assert warc.read_archives(none).count() == warc.merge_runs(none).count() == 0


def test_loser_tree_merges_any_number_of_runs():
    random = np.random.default_rng(0)
    for size in range(0, 9):
        runs = [sorted(random.integers(0, 50, random.integers(0, 9)).tolist()) for _ in range(size)]
        merged = list(warc.LoserTree([iter(r) for r in runs]))
        assert merged == sorted(x for r in runs for x in r)


def test_pipeline_stages(spark, odd, empty, tmp_path):
    labels = spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    # One of the three rows of "b text", the last id of the blank texts, no row of the others.
    for docs, ids in ((odd, [None, 3, 4, 5]), (empty, [])):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == odd.columns
        assert sorted((r["doc_id"] for r in docs.collect()), key=lambda i: (i or 0)) == ids
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
        assert {r["doc_id"] for r in packed.collect()} == set(ids)


def test_near_copies_go_by_id_and_fingerprint(spark, rows):
    one, two = "a text that is found once more", "of this there is another copy here"
    docs = rows(
        "doc_id long, text string, code string",
        (1, one, "stays"), (None, one, "goes"), (None, "unlike all others", "stays"),
        (None, None, "stays"), (3, two, "stays"), (7, two, "goes"), (7, "also unlike", "stays"),
        (8, "the same id twice", "stays"), (8, "and no copy of it", "stays"),
    )
    left = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert left.columns == docs.columns
    assert left.filter("code = 'stays'").count() == left.count() == 7


def test_near_copies_that_share_the_smallest_id(spark, rows):
    base = " ".join(f"w{i}" for i in range(400))
    texts = [(8, base), (8, base + " x"), (9, base), (8, base), (7, "other words here now")]
    texts += [(8, "not like the others with this id"), (None, "no id"), (None, "no id")]
    docs = rows("doc_id long, text string", *texts)
    left = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert sorted(r["doc_id"] or 0 for r in left.collect()) == [0, 7, 8, 8]


def test_captures_are_in_order_of_any_second(spark, rows):
    ids = [0, 5, -1, -(1 << 40), (1 << 35) + 1, 1 << 35, (1 << 62), -(1 << 62), None]
    pages = rows("page_id long, url string, html string", *[(i, "http://a/", f"{i}") for i in ids])
    runs = warc.write_archives(pages, scratch_path(spark, "w"))
    found = [r["page_id"] for r in warc.merge_runs(runs).orderBy("place").collect()]
    known = sorted(i for i in ids if i is not None)
    assert [i for i in found if i is not None] == known
    assert found.index(None) in (known.index(0), known.index(0) + 1)  # null is second 0
    assert warc.read_archives(runs).count() == len(ids)


def test_clustering(spark, monkeypatch):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 1), (1, [1.0, 2.0], 2), (1, [1.0, 2.0], 2), (2, [-3.5, 0.25], 3),
        (3, None, 4), (4, [nan, 1.0], 5), (5, [None, 1.0], 6), (6, [inf, 0.0], 7),
        (7, [1.0], 8), (None, [9.0, 9.0], 9), (8, [], 10),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cluster int")
    found = vafile.cluster(vafile.whole_rows(vectors, dims=2), clusters=40, dims=2).collect()
    assert sorted((-1 if r["vec_id"] is None else r["vec_id"]) for r in found) == [-1, 0, 1, 1, 2]
    assert all(r["distance"] == 0 for r in found if r["vec_id"] is not None)
    assert len(found) == 5 and len({r["inertia"] for r in found}) == 1
    assert sum({r["cluster"]: r["cluster_inertia"] for r in found}.values()) == found[0]["inertia"]
    nothing = vafile.whole_rows(vectors.limit(0), dims=2)
    assert vafile.cluster(nothing, dims=2).count() == 0
    unnamed = vafile.whole_rows(vectors.filter("vec_id is null"), dims=2)
    assert vafile.cluster(unnamed, dims=2).count() == 0
    with pytest.raises(Exception, match="beyond"):
        large = spark.createDataFrame([(1, [1e9, 0.0])], "vec_id long, embedding array<double>")
        vafile.cluster(vafile.whole_rows(large, dims=2), dims=2).collect()


def test_clustering_equals_brute_force_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(vafile, "BLOCK", 37)
    random = np.random.default_rng(8)
    values = np.floor(random.normal(size=(600, 5)) * 40).astype(int)
    values[200:400] = values[3]  # a third of all rows are one vector
    frame = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(values)], "vec_id long, vector array<long>"
    )
    read = []
    found = vafile.cluster(frame.repartition(5), 9, 4, "s", 5, read).collect()
    first = sorted(range(600), key=lambda i: hashlib.sha256(f"s{i}".encode()).hexdigest())[:9]
    points = values[first].copy()
    nearest = lambda: ((values[:, None] - points) ** 2).sum(axis=2)
    for _ in range(4):
        own = nearest().argmin(axis=1)
        for k in set(own):
            points[k] = values[own == k].sum(axis=0) // (own == k).sum()
    away = nearest()
    own, least = away.argmin(axis=1), away.min(axis=1)
    for r in found:
        i = r["vec_id"]
        assert (r["cluster"], r["distance"], r["inertia"]) == (own[i], least[i], least.sum())
        text = ",".join(map(str, points[own[i]]))
        assert r["centroid_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert len(found) == 600 and read[0] == 600 and read[-1] < 600


def test_ngram_groups(spark, odd, empty):
    found = ngrams.similar_groups(odd).collect()
    got = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in found)
    assert got == [
        (0, 0, None), (0, 1, None), (1, 1, 1), (2, 0, 2), (3, 0, 3), (4, 5, 4), (5, 1, 1), (5, 1, 1),
    ]
    assert ngrams.similar_groups(empty).count() == 0
    blank = odd.filter("text is null or text = ''")
    assert ngrams.similar_groups(blank).count() == 3


def test_ngram_groups_keep_little_on_disk(spark, tmp_path):
    """The rows of signatures do not stay, and no join shuffles all texts, at whatever size."""
    words = [f"w{i}" for i in np.random.default_rng(3).integers(0, 1 << 30, 90_000)]
    texts = [" ".join(words[90 * i : 90 * i + 90]) for i in range(1000)]
    texts += [f"{text} more" for text in texts[:20]]  # the only ones that link
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    before = spark.sparkContext.getCheckpointDir()
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = {r["doc_id"]: r["component_id"] for r in ngrams.similar_groups(frame).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
        if before:
            spark.sparkContext.setCheckpointDir(before)
    assert found == {i: i - 1000 if i >= 1000 else i for i in range(1020)}
    left = {p.name.rsplit("-", 1)[0] for p in tmp_path.rglob("ledgerstar/*-*")}
    assert not left & {"profiles", "signed"} and "every" in left


@pytest.mark.parametrize("words", [64, 1 << 20])
def test_ngram_texts_are_held_against_a_bitmap_first(spark, monkeypatch, words):
    monkeypatch.setattr(ngrams, "WORDS", words)
    narrow = spark.createDataFrame([(i, "x") for i in [*range(3000), None]], "doc_id long, text string")
    ids = spark.createDataFrame([(i,) for i in range(0, 3000, 3)], "first_id long")
    found = ngrams._held(narrow, ids)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" in plan and "SortMergeJoin" in plan
    assert sorted(r["doc_id"] for r in found.collect()) == list(range(0, 3000, 3))
    bitmap, size = ngrams._bitmap(ids, "first_id")
    assert size == (64 if words == 64 else 256)
    [row] = bitmap.collect()
    assert len(row["bitmap"]) == size
    assert ngrams._held(narrow, ids.limit(0)).count() == 0


def _edited(random, base, share):
    return [f"n{random.integers(1 << 30)}" if random.random() < share else w for w in base]


@pytest.mark.parametrize("sizes", [None, (8, 2), (3, 1)])
def test_ngram_groups_equal_brute_force(spark, monkeypatch, sizes):
    """Families of copies with few and many edits; small blocks make every step run."""
    if sizes:
        monkeypatch.setattr(ngrams, "BLOCK_SETS", sizes[0])
        monkeypatch.setattr(ngrams, "PIVOTS", sizes[1])
    random = np.random.default_rng(9)
    texts = []
    for family in range(4):
        base = [f"f{family}w{i}" for i in range(int(random.integers(5, 120)))]
        for _ in range(15):
            texts.append(" ".join(_edited(random, base, random.choice([0, 0.01, 0.03]))))
    texts += [" ".join(f"w{i}" for i in random.integers(0, 9, 12)) for _ in range(20)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    sets = []
    for text in texts:
        words = text.split()
        sets.append({tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))})
    part = list(range(len(sets)))
    for _ in range(len(sets)):
        for i, x in enumerate(sets):
            for j in range(i):
                if 100 * len(x & sets[j]) >= 85 * len(x | sets[j]):
                    part[i] = part[j] = min(part[i], part[j])
    found = {r["doc_id"]: r for r in ngrams.similar_groups(frame).collect()}
    assert {i: r["component_id"] for i, r in found.items()} == dict(enumerate(part))
    assert all(r["n_shingles"] == len(sets[i]) for i, r in found.items())
    assert len(set(part)) < len(part)


def test_ranked_search(spark, odd, empty):
    items = spark.createDataFrame(
        [(1, "the DAY", 5), (2, None, 6), (None, "Text!", 7), (4, "nowhere", 8), (1, "the DAY", 9)],
        "item_id long, text string, score int",
    )
    found = lexical.search(odd, items, top=3).collect()
    got = sorted((r["item_id"] or 0, r["rank"], r["doc_id"]) for r in found)
    assert got == [(0, 1, 1), (0, 2, 5), (0, 3, 5), (1, 1, 4), (1, 1, 4)]
    assert lexical.search(empty, items).count() == 0
    assert lexical.search(odd, items.limit(0)).count() == 0


def test_ranked_search_in_small_blocks_and_groups(spark, monkeypatch):
    whole = {}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    for name, value in ((None, None), ("BLOCK_DOCS", 7), ("BLOCK_TERMS", 50), ("QUERY_TERMS", 60)):
        if name:
            monkeypatch.setattr(lexical, name, value)
        whole[name] = sorted(map(tuple, lexical.search(docs, items, top=9).collect()))
    assert whole["BLOCK_DOCS"] == whole["BLOCK_TERMS"] == whole["QUERY_TERMS"] == whole[None]
    assert len(whole[None]) > 100


def test_damaged_archives_are_refused():
    data, _ = warc.record(7, "http://a.org", "2026-01-01T00:00:07Z", b"x" * 100_000, None, False)
    whole = warc.packed(data) * 2
    found = list(warc.parse(pa.BufferReader(whole)))
    assert [p for p, _, _ in found] == [0, len(whole) // 2] and len(found[1][2]) > 100_000
    bad = bytearray(whole)
    bad[len(whole) // 4] ^= 255
    for broken in (bytes(bad), whole[:-5]):
        with pytest.raises(ValueError):
            list(warc.parse(pa.BufferReader(broken)))
