"""One registered query per operator, over the whole of its table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakejobs.llm import (
    apportionment, conversation_repair, hard_negatives, jaccard_join, licence_automaton, lookup_sketch, mil_quality,
    permutation_index, repair_sql, sampling, secret_scan, secret_sql, string_kernel,
    token_counts, vector_packing, warc_convert,
)
from lakejobs.llm.shipping import ship
from lakejobs.session import fresh_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run):
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return run(spark, sf_dir)

    QUERIES[run.__name__] = shipped
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_warc_convert(spark, sf_dir):
    """Pages as legacy archives, converted to WARC files and read back."""
    work = fresh_dir(spark, "archives")
    warc_convert.write_arc(table(spark, sf_dir, "pages"), f"{work}/arc")
    warc_convert.convert(spark, f"{work}/arc", f"{work}/warc", least=1000)
    return warc_convert.read_warc(spark, f"{work}/warc").select(
        F.col("source_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        "refers_to")


@query
def op2_permutation_index(spark, sf_dir):
    """The 5 nearest of every 50th vector."""
    index = permutation_index.build(table(spark, sf_dir, "embeddings"))
    return permutation_index.search(index, F.col("vec_id") % 50 == 0, k=5)


@query
def op3_lookup_sketch(spark, sf_dir):
    """Fingerprints of every document, of its edited text, and their likeness."""
    return lookup_sketch.versions(table(spark, sf_dir, "documents"))


@query
def op4_vector_packing(spark, sf_dir):
    """All documents in sequences of at most 2048 tokens."""
    return vector_packing.pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        end_id=1, max_tokens=2048, max_segments=256)


@query
def op5_mil_quality(spark, sf_dir):
    """The quality of every document, learnt outside the held-out share."""
    docs = table(spark, sf_dir, "documents")
    model = mil_quality.learn(docs, table(spark, sf_dir, "labels"))
    return docs.select(
        "doc_id", sampling.held_out(F.col("doc_id")).alias("held_out"),
        mil_quality.quality_score(F.col("text"), model).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query
def op6_string_kernel(spark, sf_dir):
    """The language of every document, learnt outside the held-out share."""
    docs = table(spark, sf_dir, "documents")
    model = string_kernel.learn(docs)
    return docs.select(
        "doc_id", sampling.held_out(F.col("doc_id")).alias("held_out"),
        string_kernel.identified(F.col("text"), model).alias("found"),
    ).select("doc_id", "held_out", "found.lang_pred", "found.score")


@query
def op7_licence_automaton(spark, sf_dir):
    """License phrases and template spans of every document."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", licence_automaton.scanned(F.col("text")).alias("found"),
    ).select("doc_id", *[f"found.{c}" for c in (
        "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")])


@query
def op8_jaccard_join(spark, sf_dir):
    """The components of documents whose 3-word shingles overlap by 90 percent or more."""
    return jaccard_join.linked_documents(
        table(spark, sf_dir, "documents"), words=3, percent=90)


@query
def op9_apportionment(spark, sf_dir):
    """The words of every document that the mix takes."""
    return apportionment.mix(table(spark, sf_dir, "documents")).select(
        "doc.doc_id", "size", "source_size", "target", "taken")


@query
def op10_token_counts(spark, sf_dir):
    """The tokens of every document."""
    counted = table(spark, sf_dir, "documents").select(
        "doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        token_counts.token_count(F.col("text"), public_tokenizers.path("word_bpe_49k.json"))
        .alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


@query
def op11_secret_scan(spark, sf_dir):
    """Secrets in every document: base patterns and stretches of high entropy."""
    found = secret_scan.scan(table(spark, sf_dir, "documents")).select("doc.doc_id", "spans")

    def of(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id", *[F.size(of(kind)).cast("long").alias(f"n_{kind}")
                    for kind in secret_scan.BASE_KINDS],
        F.sha2(secret_scan.written(of(*secret_scan.BASE_KINDS)), 256).alias("base_sha256"),
        secret_scan.written(F.col("spans")).alias("spans"))


@query
def op12_conversation_repair(spark, sf_dir):
    """Damaged conversations: their faults and their cheapest repair."""
    return conversation_repair.repair(
        conversation_repair.damage(table(spark, sf_dir, "conversations")), times_col="times")


@query
def op13_hard_negatives(spark, sf_dir):
    """Hard negatives of every 50th vector, below each of its 5 first positives."""
    wrong = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(
        F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", wrong.alias("label"))
    return hard_negatives.mine(hard_negatives.prepared(vectors), F.col("vec_id") % 50 == 0)


ORACLES = {
    "op13_hard_negatives": """
        WITH usable AS (
            SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END
                                AS BIGINT) AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                   CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
            FROM usable a JOIN usable b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (
                PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN scored USING (anchor_id)
        WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER w <= 3""",
    "op12_conversation_repair": repair_sql.oracle(),
    "op11_secret_scan": secret_sql.oracle(),
    "op1_warc_convert": """
        WITH sized AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n,
                   sha1(coalesce(html, '')) AS digest FROM pages),
        known AS (
            SELECT digest AS d, max(page_id) AS last FROM sized WHERE n >= 1000 GROUP BY digest)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
               CASE WHEN last IS NULL OR last = page_id THEN 'response' ELSE 'revisit' END
                   AS record_type,
               CASE WHEN last <> page_id THEN last END AS refers_to
        FROM sized LEFT JOIN known ON digest = d""",
    "op8_jaccard_join": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
                       lambda w: w <> '') AS w
            FROM documents),
        sets AS (
            SELECT doc_id, list_distinct(CASE
                       WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1),
                           lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
                       WHEN len(w) > 0 THEN [array_to_string(w, ' ')]
                       ELSE [] END) AS s
            FROM words),
        sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n, list_sort(s) AS s FROM sets),
        classes AS (SELECT s, n, min(doc_id) AS one FROM sizes WHERE n > 0 GROUP BY s, n),
        tokens AS (SELECT one, n, unnest(s) AS t FROM classes),
        pairs AS (
            SELECT a.one AS x, b.one AS y FROM tokens a JOIN tokens b
                ON a.t = b.t AND a.one < b.one AND 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n)
            GROUP BY a.one, b.one, a.n, b.n
            HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
        links AS (SELECT x, y FROM pairs UNION SELECT y, x FROM pairs),
        reach AS (
            SELECT one AS x, one AS y FROM classes
            UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
        roots AS (SELECT x, min(y) AS root FROM reach GROUP BY x)
        SELECT doc_id, sizes.n AS n_shingles, coalesce(root, doc_id) AS component_id
        FROM sizes LEFT JOIN classes ON sizes.s = classes.s AND sizes.n > 0
        LEFT JOIN roots ON roots.x = classes.one""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
