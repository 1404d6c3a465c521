"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillset.llm import (
    decontaminate,
    embedding_dedup,
    html_extract,
    language,
    lexical_search,
    merkle,
    packing,
    prefix_trie,
    quality,
    simhash,
    suffix_dedup,
    token_files,
    toxicity,
)
from quillset.llm.common import held_out
from quillset.session import stage

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return found.select(
        "doc_id",
        n_bytes.alias("n_bytes"),
        (n_bytes - F.octet_length("kept")).alias("n_removed"),
        F.size("repeats").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def grades(labels: DataFrame) -> DataFrame:
    """Graded ratings: 0 poor, 1 good but toxic, 2 good."""
    toxic = F.coalesce(F.col("toxic"), F.lit(0))
    grade = F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, 2 - toxic)
    return labels.select("doc_id", grade.alias("grade"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, grades(table(spark, sf_dir, "labels")))
    return quality.rate(docs, model).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "expected_grade",
        "tail_probability",
        (F.col("tail_probability") >= quality.LEAST_TAIL).alias("selected"),
    )


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "hits.n_words",
        "hits.n_hit",
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hits.items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("hits.n_hit") > 0).alias("contaminated"),
    )


def damaged(records: DataFrame) -> DataFrame:
    """A replica in which some records are gone, some have a wrong byte, some end early and some are new."""
    key, payload = F.col("record_id"), F.col("payload")
    broken = (
        F.when(key % 101 == 7, F.concat(F.lit("X").cast("binary"), F.substring(payload, 2, 1 << 30)))
        .when(key % 103 == 5, F.substring(payload, 1, F.octet_length(payload) - 1))
        .otherwise(payload)
    )
    kept = records.filter(F.coalesce(key % 97 != 3, F.lit(True))).withColumn("payload", broken)
    new = records.filter(key % 107 == 11).withColumn("offset", F.col("offset") + 1)
    return kept.union(new)


def op5_warc_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = stage(merkle.placed(merkle.warc_records(table(spark, sf_dir, "pages"))), "records")
    return merkle.audit(records, damaged(records))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.identify(docs.drop("lang"), language.fit(docs))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html_extract.extract(pages, html_extract.fit())
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.roundtrip(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_quality": op2_quality,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_decontaminate": op4_decontaminate,
    "op5_warc_merkle": op5_warc_merkle,
    "op6_language": op6_language,
    "op7_html_extract": op7_html_extract,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_toxicity": op9_toxicity,
    "op10_simhash": op10_simhash,
    "op11_lexical_search": op11_lexical_search,
    "op12_token_files": op12_token_files,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES: dict[str, str] = {
    "op5_warc_merkle": """
        WITH sized AS (
            SELECT page_id AS record_id, page_id // 500 AS file,
                octet_length(encode(concat('WARC/1.0', chr(13), chr(10), 'WARC-Type: response', chr(13), chr(10),
                    'WARC-Record-ID: <urn:page:', page_id, '>', chr(13), chr(10), 'WARC-Target-URI: ', url,
                    chr(13), chr(10), 'Content-Length: ', octet_length(encode(html)), chr(13), chr(10), chr(13), chr(10),
                    html, chr(13), chr(10), chr(13), chr(10)))) AS length
            FROM pages
        ), placed AS (
            SELECT *, CAST(coalesce(sum(length) OVER (PARTITION BY file ORDER BY record_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
            FROM sized
        )
        SELECT file, "offset", record_id, 'missing' AS damage FROM placed WHERE record_id % 97 = 3
        UNION ALL
        SELECT file, "offset", record_id, 'corrupt' AS damage FROM placed
        WHERE record_id % 97 <> 3 AND (record_id % 101 = 7 OR record_id % 103 = 5)
        UNION ALL
        SELECT file, "offset" + 1 AS "offset", record_id, 'extra' AS damage FROM placed WHERE record_id % 107 = 11
    """,
    "op11_lexical_search": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS place, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents
        ), items AS (
            SELECT row_number() OVER () AS item, item_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM benchmark
        ), asked AS (
            SELECT DISTINCT item, item_id, term FROM (SELECT item, item_id, unnest(terms) AS term FROM items)
        ), counts AS (
            SELECT CAST(count(*) FILTER (len(terms) > 0) AS BIGINT) AS docs, CAST(sum(len(terms)) AS BIGINT) AS terms FROM docs
        ), postings AS (
            SELECT place, doc_id, n, term, count(*) AS tf
            FROM (SELECT place, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs)
            WHERE term IN (SELECT term FROM asked) GROUP BY ALL
        ), weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * c.docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM postings, counts c GROUP BY term, c.docs
        ), scores AS (
            SELECT a.item, a.item_id, p.place, p.doc_id, sum(w.w * ((1000000000 * p.tf)
                // (1000 * p.tf + 20 * (100 - 50 + (50 * p.n * c.docs) // c.terms)))) AS score
            FROM asked a JOIN postings p USING (term) JOIN weights w USING (term), counts c
            GROUP BY ALL
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST, place) AS rank
            FROM scores WHERE score > 0
        )
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 50
    """,
    "op13_prefix_trie": """
        WITH numbered AS (
            SELECT conv_id AS c, strlen(coalesce(text, '')) AS size,
                sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS digest,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                    sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) - 1 AS at
            FROM conversations WHERE conv_id IS NOT NULL
        ), asked AS (
            SELECT DISTINCT c, c - c % 5 AS base, xor(list_reduce(
                list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ord(x) AS UBIGINT)),
                lambda a, b: list_reduce(list_transform(range(8), lambda i: CAST(0 AS UBIGINT)),
                    lambda y, i: xor(y >> 1, (y & 1) * CAST(3988292384 AS UBIGINT)), xor(a, b)),
                CAST(4294967295 AS UBIGINT)), CAST(4294967295 AS UBIGINT)) % 9 AS h
            FROM numbered
        ), shifts AS (
            SELECT k.c, k.h, k.base, count(b.at) AS borrowed
            FROM asked k LEFT JOIN numbered b ON b.c = k.base AND b.at < k.h GROUP BY ALL
        ), rebuilt AS (
            SELECT k.c, b.at + 1 AS depth, b.size, b.digest FROM shifts k JOIN numbered b ON b.c = k.base AND b.at < k.h
            UNION ALL
            SELECT k.c, k.borrowed + t.at - k.h + 1 AS depth, t.size, t.digest
            FROM shifts k JOIN numbered t ON t.c = k.c AND t.at >= k.h
        ), named AS (
            SELECT c, depth, size, sha256(string_agg(digest, '') OVER (PARTITION BY c ORDER BY depth)) AS name FROM rebuilt
            UNION ALL
            SELECT c, 0 AS depth, 0 AS size, '' AS name FROM asked
        ), nodes AS (
            SELECT depth, name, min(c) AS owner, count(*) AS n_convs, max(size) AS size FROM named GROUP BY depth, name
        ), paths AS (
            SELECT named.c, named.depth, nodes.owner FROM named JOIN nodes USING (depth, name)
        ), placed AS (
            SELECT n.owner, n.depth, n.n_convs, (n.n_convs - 1) * n.size AS saved, p.owner AS parent
            FROM nodes n LEFT JOIN paths p ON p.c = n.owner AND p.depth = n.depth - 1
        ), children AS (
            SELECT parent AS owner, depth - 1 AS depth, count(*) AS n_children FROM placed WHERE depth > 0 GROUP BY ALL
        ), weighed AS (
            SELECT placed.*, coalesce(n_children, 0) AS n_children FROM placed LEFT JOIN children USING (owner, depth)
        ), totals AS (
            SELECT p.owner, p.depth, sum(w.saved) AS saved, sum(CASE WHEN w.n_children = 0 THEN 1 ELSE 0 END) AS leaves
            FROM weighed w JOIN paths p ON p.c = w.owner AND p.depth <= w.depth GROUP BY p.owner, p.depth
        ), ends AS (
            SELECT p.owner, p.depth, sha256(string_agg(CAST(p.c AS VARCHAR), ',' ORDER BY p.c)) AS ends
            FROM paths p JOIN (SELECT c, max(depth) AS depth FROM paths GROUP BY c) e ON e.c = p.c AND e.depth = p.depth
            GROUP BY p.owner, p.depth
        )
        SELECT w.owner AS conv_id, CAST(w.depth AS BIGINT) AS depth, w.parent AS parent_conv_id,
            CAST(w.n_convs AS BIGINT) AS n_convs, CAST(w.n_children AS BIGINT) AS n_children,
            CAST(t.leaves AS BIGINT) AS n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens,
            coalesce(e.ends, sha256('')) AS ends_sha256
        FROM weighed w JOIN totals t USING (owner, depth) LEFT JOIN ends e USING (owner, depth)
    """,
}
