"""The operators as queries over the test tables, and the same results in SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstar.llm import (
    chat,
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
from ledgerstar.llm.common import table
from ledgerstar.session import scratch_path

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's three best segmentations, encoded and decoded again."""
    found = pieces.round_trips(table(spark, sf_dir, "documents"), PIECE_BPE, n=3)
    return found.select(
        "doc_id",
        "n_pieces",
        "ids_crc32",
        "same_text",
        F.get("scores", F.lit(0)).alias("score"),
        F.get("scores", F.lit(1)).alias("second_score"),
        F.get("scores", F.lit(2)).alias("third_score"),
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of license phrases, and the labels of all notices, in every document."""
    found = licenses.scan_documents(table(spark, sf_dir, "documents"))
    base = F.filter("matches", lambda m: m["phrase"])
    labels = lambda matches: F.array_join(
        F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ","
    )
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(F.transform(base, lambda m: m["start"])).alias("first_word"),
        F.array_max(F.transform(base, lambda m: m["start"])).alias("last_word"),
        labels(base).alias("base_labels"),
        labels("matches").alias("labels"),
        F.coalesce(
            F.array_max(F.transform("matches", lambda m: m["containment"])), F.lit(0.0)
        ).alias("score"),
    )


def op3_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dialogue from each participant's side: its parts, their texts and masks."""
    parts = chat.perspectives(table(spark, sf_dir, "conversations"))
    learned = F.aggregate("spans", F.lit(0), lambda a, s: a + s["end"] - s["start"])
    spans = F.transform("spans", lambda s: F.concat_ws("-", s["start"], s["end"]))
    return parts.select(
        "conv_id",
        "speaker",
        "part",
        "first_turn",
        "n_turns",
        F.char_length("text").alias("n_chars"),
        F.sha2("text", 256).alias("text_sha256"),
        learned.alias("n_learned"),
        F.array_join(spans, ",").alias("spans"),
    )


def op4_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document written as checked binary records and read back."""
    docs = table(spark, sf_dir, "documents")
    index = records.write_records(docs, scratch_path(spark, "records"), BYTE_BPE)
    return records.read_records(index)


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five largest products of every fiftieth vector with all others."""
    vectors = pivots.whole_vectors(table(spark, sf_dir, "embeddings"))
    return pivots.top_products(vectors, F.col("vec_id") % 50 == 0, top=5)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score, by a grammar fitted on the labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), BYTE_BPE)


def op9_warc_index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as archives read back, with each capture's place in the merged index."""
    runs = warc.write_archives(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    places = warc.merge_runs(runs).select("run", "position", "url_key", "place")
    # Names of archives compress so well that their size on disk says nothing.
    found = warc.read_archives(runs).join(places.hint("merge"), ["run", "position"])
    return found.drop("run", "position")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's nearest of 40 centroids after five rounds."""
    return vafile.cluster(vafile.whole_rows(table(spark, sf_dir, "embeddings")))


def op12_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group by Jaccard similarity of its shingles of four words."""
    return ngrams.similar_groups(table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark item's 50 best documents."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return lexical.search(docs, items, top=50)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_license_scan": op2_license_scan,
    "op3_chat_perspectives": op3_chat_perspectives,
    "op4_token_records": op4_token_records,
    "op5_exact_top_k": op5_exact_top_k,
    "op6_toxicity": op6_toxicity,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_warc_index_merge": op9_warc_index_merge,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_ngram_jaccard_join": op12_ngram_jaccard_join,
    "op13_ranked_search": op13_ranked_search,
}


def _clustering_sql(clusters: int = 40, rounds: int = 5) -> str:
    """Rounds of assignment and means one after another, as common table expressions."""
    parts = [
        """WITH kept AS MATERIALIZED (
            SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
            WHERE len(embedding) = 64
                AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)""",
        f"""c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY hash) - 1 AS c, v AS m FROM (
                SELECT v, sha256('2:' || vec_id) AS hash FROM kept ORDER BY hash LIMIT {clusters}))""",
    ]
    for i in range(rounds + 1):
        parts.append(
            f"""a{i} AS MATERIALIZED (
            SELECT vec_id, v, near.c, near.d FROM (
                SELECT vec_id, any_value(v) AS v, min(struct_pack(d := (list_inner_product(v, v)
                    - 2 * list_inner_product(v, m) + list_inner_product(m, m))::BIGINT, c := c)) AS near
                FROM kept, c{i} GROUP BY vec_id))"""
        )
        if i < rounds:
            parts.append(
                f"""c{i + 1} AS MATERIALIZED (
            SELECT o.c, coalesce(n.m, o.m) AS m FROM c{i} o LEFT JOIN (
                SELECT c, list(floor(s / n) ORDER BY place) AS m FROM (
                    SELECT c, place, sum(x) AS s, count(*) AS n FROM (
                        SELECT c, unnest(v) AS x, unnest(range(64)) AS place FROM a{i})
                    GROUP BY c, place) GROUP BY c) n ON o.c = n.c)"""
            )
    return ", ".join(parts) + f"""
        SELECT vec_id, a.c::INT AS cluster, d AS distance,
            sum(d) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia,
            sum(d) OVER ()::BIGINT AS inertia,
            sha256(array_to_string([x::BIGINT::VARCHAR FOR x IN m], ',')) AS centroid_sha256
        FROM a{rounds} a JOIN c{rounds} c ON a.c = c.c
    """


ORACLES: dict[str, str] = {
    "op3_chat_perspectives": """
        WITH turns AS (
            SELECT conv_id, role, CASE WHEN role IS NULL THEN '_none' ELSE replace(replace(replace(
                    replace(role, '_', '__'), '|', '_p'), chr(13), '_r'), chr(10), '_l') END AS name,
                replace(coalesce(text, ''), '<|', '< |') AS text, turn
            FROM conversations),
        numbered AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id
                ORDER BY turn NULLS FIRST, role NULLS FIRST, text) - 1 AS rank FROM turns),
        speakers AS (
            SELECT DISTINCT conv_id, role AS speaker FROM turns WHERE role IS DISTINCT FROM 'system'),
        rendered AS (
            SELECT n.conv_id, speaker, (rank // 64)::INT AS part, rank,
                role IS NOT DISTINCT FROM speaker AS learn,
                CASE WHEN role IS NOT DISTINCT FROM 'system' THEN '<|system|>'
                    WHEN role IS NOT DISTINCT FROM speaker THEN '<|assistant|>'
                    ELSE '<|user name=' || name || '|>' END || chr(10) AS header,
                text || '<|end|>' || chr(10) AS body
            FROM numbered n JOIN speakers s ON n.conv_id IS NOT DISTINCT FROM s.conv_id),
        placed AS (
            SELECT *, sum(length(header) + length(body)) OVER (
                PARTITION BY conv_id, speaker, part ORDER BY rank) AS stop FROM rendered)
        SELECT conv_id, speaker, part, min(rank) AS first_turn, count(*)::INT AS n_turns,
            max(stop)::INT AS n_chars,
            sha256(string_agg(header || body, '' ORDER BY rank)) AS text_sha256,
            coalesce(sum(length(body)) FILTER (WHERE learn), 0)::INT AS n_learned,
            coalesce(string_agg((stop - length(body))::INT || '-' || stop::INT, ','
                ORDER BY rank) FILTER (WHERE learn), '') AS spans
        FROM placed GROUP BY conv_id, speaker, part
    """,
    "op5_exact_top_k": """
        WITH whole AS (
            SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS vector
            FROM embeddings
            WHERE len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                list_inner_product(q.vector, c.vector)::BIGINT AS score
            FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
        SELECT query_id, rank, vec_id, score
        FROM (SELECT *, row_number() OVER (
                PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
        WHERE rank <= 5
    """,
    "op11_centroid_clustering": _clustering_sql(),
    "op12_ngram_jaccard_join": """
        WITH RECURSIVE split AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
        held AS MATERIALIZED (
            SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
                WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                ELSE [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)] END) AS s
            FROM split),
        flat AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM held),
        links AS MATERIALIZED (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM flat a JOIN flat b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
                AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
            GROUP BY a.doc_id, b.doc_id, a.n, b.n
            HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
        reached AS (
            SELECT doc_id AS a, doc_id AS b FROM documents
            UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a)
        SELECT h.doc_id, len(s)::BIGINT AS n_shingles, min(r.b) AS component_id
        FROM held h JOIN reached r ON h.doc_id = r.a GROUP BY h.doc_id, len(s)
    """,
    "op13_ranked_search": """
        WITH found AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
        counted AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM found GROUP BY ALL),
        sizes AS MATERIALIZED (SELECT doc_id, sum(tf)::BIGINT AS n FROM counted GROUP BY doc_id),
        whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM sizes),
        weights AS MATERIALIZED (
            SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
            FROM counted, whole GROUP BY term, docs),
        asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        scored AS (
            SELECT item_id, doc_id, sum(w * ((1000000000 * tf)
                // (1000 * tf + 20 * (50 + (50 * n * docs) // length))))::BIGINT AS score
            FROM asked JOIN weights USING (term) JOIN counted USING (term) JOIN sizes USING (doc_id),
                whole
            GROUP BY item_id, doc_id)
        SELECT item_id, rank, doc_id, score
        FROM (SELECT *, row_number() OVER (
                PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank
            FROM scored WHERE score > 0)
        WHERE rank <= 50
    """,
    "op10_exact_dedup": """
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
        FROM (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256,
                max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
                count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size
              FROM documents)
    """,
}
