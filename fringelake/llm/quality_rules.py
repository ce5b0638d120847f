"""Quality rules as a ledger: every rule is measured once and leaves one bit; policies and ablations read the bits.

``ledger`` reads each text once and returns the measurements and ``failed``, a bit mask with one bit per rule of RULES.
A policy is a named, versioned mask; a row is kept under it if none of the policy's bits failed. Changing a policy, or
asking what each rule of it costs (``ablation``), is bitwise arithmetic and aggregation on the ledger and reads no text.
Only DataFrame functions are used, and nothing is shuffled except the few counters of an ablation.

Repeated windows are found per text by sorting (hash, place) pairs, n log n for n words, so a very long text costs no
more per word than a short one; the hash is a 64-bit one of the three words.

Defined results: null text counts as no text (no words, zeros, base_failed); an id of null is kept as it is; repeated rows
each get their own row; no rows in, no rows out; other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fringelake.llm.common import text_of

SYMBOLS = "#*$%&|<>"
SPACES = "\t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Rule:
    """`fails` is SQL over the ledger's measurements; null never arises in them."""

    name: str
    fails: str


#: The place in this list is the bit. Append only: stored ledgers refer to it.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule("short_or_long_words", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    Rule("exclamations", "10 * n_exclamations > 3 * n_words"),
)
BIT = {rule.name: 1 << place for place, rule in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_windows"]


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    mask: int


POLICIES = (
    Policy("base", 1, BASE),
    Policy("prose", 1, BASE | BIT["symbols"] | BIT["repeated_lines"]),
    Policy("prose", 2, BASE | BIT["symbols"] | BIT["repeated_lines"] | BIT["short_or_long_words"] | BIT["exclamations"]),
)


def _size(array: Column) -> Column:
    return F.size(array).cast("long")


def _n_chars(text: Column, among: str) -> Column:
    return (F.char_length(text) - F.char_length(F.translate(text, among, ""))).cast("long")


def _windows(words: Column) -> Column:
    """(hash, place of the last word) of every three-word window, sorted by hash. `words` must be a column, not an
    expression: a lambda evaluates expressions once per element."""
    return F.sort_array(F.when(F.size(words) >= 3, F.transform(
        F.sequence(F.lit(2), F.size(words) - 1),
        lambda i: F.struct(F.xxhash64(F.get(words, i - 2), F.get(words, i - 1), F.get(words, i)).alias("h"), i.alias("i")),
    )))


def _repeated(ordered: Column) -> Column:
    """Places of the windows that have a neighbour of the same hash in the order; `ordered` must be a column."""
    return F.array_sort(F.array_compact(F.transform(ordered, lambda e, k: F.when(
        (F.get(ordered, k - 1)["h"] == e["h"]) | (F.get(ordered, k + 1)["h"] == e["h"]), e["i"]
    ))))


def _covered(places: Column) -> Column:
    """Words in those windows: each window's last word, and its first two unless the window before it has them."""
    return F.coalesce(F.aggregate(
        places,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).alias("last")),
        lambda s, i: F.struct((s["n"] + F.least(F.lit(3), i - s["last"])).alias("n"), i.alias("last")),
        lambda s: s["n"],
    ), F.lit(0).cast("long"))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, the measurements and `failed`."""
    read = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t"))
    spaced = read.select("id", "t", F.array_remove(F.split(F.translate("t", SPACES, " " * len(SPACES)), " "), "").alias("words"))
    lines = F.filter(F.split("t", "\n"), lambda line: F.trim(F.translate(line, SPACES, " " * len(SPACES))) != "")
    sized = spaced.withColumn("lines", lines).withColumn("ordered", _windows(F.col("words")))
    measured = sized.select(
        "id",
        _size(F.col("words")).alias("n_words"),
        (F.char_length("t") - _n_chars(F.col("t"), " " + SPACES)).cast("long").alias("word_chars"),
        _n_chars(F.col("t"), SYMBOLS).alias("n_symbols"),
        (_size(F.col("lines")) - _size(F.array_distinct("lines"))).alias("n_dup_lines"),
        _size(F.col("lines")).alias("n_lines"),
        _n_chars(F.col("t"), "!").alias("n_exclamations"),
        _covered(_repeated(F.col("ordered"))).alias("n_repeat_words"),
    )
    bits = [F.when(F.expr(rule.fails), F.lit(BIT[rule.name])).otherwise(F.lit(0)) for rule in RULES]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measured.withColumn("failed", failed)


def verdict(policy: Policy, failed: str = "failed") -> Column:
    return F.col(failed).bitwiseAND(F.lit(policy.mask)) == 0


def ablation(ledgered: DataFrame, policies=POLICIES) -> DataFrame:
    """For each policy and each of its rules: rows that fail it, and rows that the policy would keep without it.

    The ledger is first counted by mask, of which there are at most 2^len(RULES).
    """
    masks = ledgered.groupBy("failed").agg(F.count("*").alias("n"))
    cases = [(p.name, p.version, r.name, p.mask, BIT[r.name]) for p in policies for r in RULES if p.mask & BIT[r.name]]
    listed = ledgered.sparkSession.createDataFrame(cases, "policy string, version int, rule string, mask int, bit int")
    within = F.col("failed").bitwiseAND(F.col("mask"))
    return masks.join(F.broadcast(listed), F.lit(True)).groupBy("policy", "version", "rule").agg(
        F.sum(F.when(F.col("failed").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(within == F.col("bit"), F.col("n")).otherwise(0)).alias("n_kept_without"),
        F.sum(F.when(within == 0, F.col("n")).otherwise(0)).alias("n_kept"),
    )


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    found = ledger(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("failed").bitwiseAND(F.lit(BASE)) != 0).alias("base_failed"), verdict(POLICIES[-1]).alias("kept"), "failed",
    )


OP4_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT r, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3),
h AS (SELECT r, i, count(*) OVER (PARTITION BY r, ws[i], ws[i + 1], ws[i + 2]) AS c FROM g),
p AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM h WHERE c > 1) GROUP BY r),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
  CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(len(ls) AS BIGINT) AS n_lines,
  CAST(length(t) - length(translate(t, '!', '')) AS BIGINT) AS n_exclamations, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN p USING (r)),
f AS (SELECT *, CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
  + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
  + CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 16 ELSE 0 END
  + CASE WHEN 10 * n_exclamations > 3 * n_words THEN 32 ELSE 0 END AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed,
  failed = 0 AS kept, CAST(failed AS INTEGER) AS failed FROM f
"""
