"""Exact deduplication by progressive refinement.

Texts are equal when they are the same after each run of ASCII white space becomes one space.
Rows are grouped by the length of that text; rows of a length that occurs more than once by the
hash of its first characters; and only rows of a (length, prefix) that occurs more than once
have their full text hashed (SHA-256). Every grouping is a partial aggregate, so a group that
holds a third of all rows is summed up before any shuffle; of the texts themselves, only those
of surviving groups may move, and none if the groups' table is small enough for Spark to
broadcast (it is a written table, so its size is known).

Defined results: null text counts as empty; of equal texts the smallest doc_id stays, a null
doc_id only if there is no other, and of rows that repeat both exactly one stays; an empty table
gives no row; other columns travel with ``distinct_documents`` whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.llm.base import documents, partitions, plain, unused, with_uid, written

PREFIX = 256


def normalised(text: str | Column = "text") -> Column:
    col = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(col.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _met(rows: DataFrame, groups: DataFrame, keys: list[str], size: str) -> DataFrame:
    """Inner join with groups whose row counts (``size``) are known. Fewer than ``n`` groups hold more than
    an ``n``-th of the rows: those are broadcast, so that no task takes a large group whole."""
    n = partitions(rows.sparkSession)
    total = groups.agg(F.sum(size).alias("n")).first().n or 0
    hot = F.col(size) > total / n
    few = F.broadcast(groups.where(hot))
    return rows.join(few, keys).unionByName(rows.join(few.select(*keys), keys, "left_anti").join(groups.where(~hot), keys))


def refined(rows: DataFrame) -> DataFrame:
    """Decisions for ``rows`` (uid, doc_id, text, length, prefix): uid, doc_id, keep_id,
    group_size, kept."""
    # summed by length and prefix before anything moves, so a length that many rows share is a few counts
    counts = written(rows.groupBy("length", "prefix").agg(F.count("*").alias("n")), "dedup-counts")
    lengths = counts.groupBy("length").agg(F.sum("n").alias("of_length")).where("of_length > 1").select("length")
    survivors = counts.join(lengths, "length", "left_semi").where("n > 1")
    survivors = written(survivors, "dedup-survivors")
    hashed = _met(rows, survivors, ["length", "prefix"], "n").select(
        "uid", "doc_id", "length", F.sha2(normalised(), 256).alias("sha")
    )
    hashed = written(hashed, "dedup-hashes")
    groups = hashed.groupBy("length", "sha").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "uid")).alias("first"),
        F.count("*").alias("group_size"),
    ).where("group_size > 1")
    groups = written(groups, "dedup-groups")
    equal = _met(hashed.select("uid", "length", "sha"), groups, ["length", "sha"], "group_size").select(
        "uid", F.col("first.doc_id").alias("keep"), F.col("first.uid").alias("keep_uid"), "group_size"
    )
    return rows.select("uid", "doc_id").join(equal, "uid", "left").select(
        "uid",
        "doc_id",
        F.when(F.col("keep_uid").isNull(), F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (F.col("keep_uid").isNull() | (F.col("keep_uid") == F.col("uid"))).alias("kept"),
    )


def _staged(docs: DataFrame) -> tuple[DataFrame, str, str, str]:
    """The table written with a row number, the normalised length and the prefix hash."""
    length, prefix = unused(docs, "norm_length"), unused(docs, "norm_prefix")
    own = unused(docs, "norm_text")
    keyed = docs.withColumn(own, normalised())
    keyed = keyed.withColumn(length, F.length(own)).withColumn(
        prefix, F.xxhash64(F.substring(own, 1, PREFIX))
    )
    staged, uid = with_uid(keyed.drop(own), "dedup-rows")
    return staged, uid, length, prefix


def _decide(staged: DataFrame, uid: str, length: str, prefix: str) -> DataFrame:
    return refined(
        staged.select(
            F.col(uid).alias("uid"),
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("text"),
            F.col(length).alias("length"),
            F.col(prefix).alias("prefix"),
        )
    )


def exact_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row."""
    staged, uid, length, prefix = _staged(plain(docs))
    digest = staged.select(F.col(uid).alias("uid"), F.sha2(normalised(), 256).alias("text_sha256"))
    return _decide(staged, uid, length, prefix).join(digest, "uid").drop("uid")


def distinct_documents(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns."""
    staged, uid, length, prefix = _staged(docs)
    dropped = _decide(staged, uid, length, prefix).where("NOT kept").select(F.col("uid").alias(uid))
    return staged.join(written(dropped, "dedup-dropped"), uid, "left_anti").select(*docs.columns)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


OP2_SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
"""
