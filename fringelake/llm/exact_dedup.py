"""Exact deduplication by progressive refinement: length, then a hash of the prefix, then a hash of everything.

Two texts are equal when they are identical after each run of ``[\\x20\\x09-\\x0D]`` is replaced by one space. A row can
have a copy only if another row has its length; of those only if another has its length and prefix hash; only what is
left is compared by SHA-256 of the whole text. Everything that moves between executors is a row of about 80 bytes, never
a text.

Which keys more than one row has is told by a bitmap of MAP_BITS bits, broadcast as at most MAP_BITS / 64 rows whatever the
size of the table. A bit may be shared by other keys, which only keeps a row that the next refinement parts from the rest;
no row is lost. So a refinement shuffles partial counts alone, never the rows of a hot key; the last step deals the rows
of each group over several tasks.

Defined results: null text counts as empty; empty texts are equal to each other; a null id never stays if another row of
its group has an id; of repeated rows (same id, same text) exactly one stays; no rows in, no rows out; other columns,
whatever their names, are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fringelake.llm.common import checkpointed, fold_space, fresh, numbered, salted_join, text_of, without_rows

#: Characters that the second refinement hashes; bits of the map of keys that rows share.
PREFIX, MAP_BITS = 64, 1 << 26


def _place(*columns):
    return F.pmod(F.xxhash64(*columns), F.lit(MAP_BITS))


def shared_keys(rows: DataFrame, *columns: str) -> DataFrame:
    """The bitmap of the keys that more than one row has: at most MAP_BITS / 64 rows."""
    keys = rows.groupBy(*columns).agg(F.count("*").alias("n")).filter("n > 1").select(_place(*columns).alias("p"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("p", F.lit(64)).cast("int"))
    return checkpointed(keys.select(F.shiftright("p", 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")))


def marked(rows: DataFrame, bitmap: DataFrame, *columns: str) -> DataFrame:
    """rows with `shared`: false for those alone with their key."""
    placed = rows.withColumn("p", _place(*columns)).withColumn("word", F.shiftright("p", 6)).join(F.broadcast(bitmap), "word", "left")
    shared = F.coalesce(F.getbit("bits", F.pmod("p", F.lit(64)).cast("int")) == 1, F.lit(False))
    return placed.withColumn("shared", shared).drop("p", "word", "bits")


def _measured(docs: DataFrame, row: str | None, id_col: str, text_col: str, digest: bool) -> DataFrame:
    """row, id, length and prefix hash of every normalised text, and its SHA-256 if asked for; one read of the table."""
    at = F.monotonically_increasing_id() if row is None else F.col(row)
    folded = docs.select(at.alias("row"), F.col(id_col).alias("id"), fold_space(text_of(text_col)).alias("t"))
    columns = ["row", "id", F.octet_length("t").cast("long").alias("length"), F.xxhash64(F.substring("t", 1, PREFIX)).alias("prefix")]
    return folded.select(*columns, *([_digest("t")] if digest else []))


def _digest(text: str):
    return F.unhex(F.sha2(text, 256)).alias("full")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: bool = False, row: str | None = None) -> DataFrame:
    """One row per row of docs: row, id, keep_id, group_size, kept, and with `digest` its SHA-256 as full.

    With `digest` the table is read once, as every text needs its hash. Without, it is read again, and only texts whose length
    and prefix more than one row has are hashed whole; rows are then told apart by the column `row` of docs, which must be the
    same in both reads (``numbered``, which is called if no `row` is given).
    """
    if not digest and row is None:
        row = fresh("row")
        docs = numbered(docs, row)
    rows = checkpointed(_measured(docs, row, id_col, text_col, digest))
    left = marked(rows, shared_keys(rows, "length"), "length").filter("shared").drop("shared")
    same, places = ["length", "prefix", "full"], shared_keys(left, "length", "prefix")
    left = marked(left, places, "length", "prefix").filter("shared").drop("shared")
    if not digest:
        again = docs.select(F.col(row).alias("row"), fold_space(text_of(text_col)).alias("t"))
        again = again.select("row", "t", F.octet_length("t").cast("long").alias("length"), F.xxhash64(F.substring("t", 1, PREFIX)).alias("prefix"))
        again = marked(again, places, "length", "prefix").filter("shared").select("row", _digest("t"))
        left = checkpointed(left.join(again, "row"))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    groups = left.groupBy(*same).agg(F.min(order).alias("first"), F.count("*").alias("n")).filter("n > 1")
    if digest:
        told = salted_join(rows, groups, same, "row", "left")
    else:
        copies = salted_join(left, groups, same, "row").select("row", "first", "n")
        told = rows.join(copies, "row", "left")
    return told.select(
        "row", "id", F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("first.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("row") == F.col("first.row"), F.lit(True)).alias("kept"), *(["full"] if digest else []),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each group of equal texts."""
    row = fresh("row")
    docs = numbered(docs, row)
    dropped = checkpointed(exact_dedup(docs, id_col, text_col, row=row).filter(~F.col("kept")).select(F.col("row").alias(row)))
    return without_rows(docs, row, dropped, dropped.count()).drop(row)


def op8_exact_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_dedup(docs, digest=True).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("full")).alias("text_sha256")
    )


OP8_SQL = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""
