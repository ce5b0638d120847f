"""A bounded sample of labelled documents, and the small fitting tools that the classifiers share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fringelake.llm.common import BLOCK_BYTES, crc_mod, first_by_hash, text_of, texts_within

#: Bounds of every classifier's fit: labelled rows of each class, and characters of their texts in all; texts are never cut.
ROWS, CHARS = 4000, 8_000_000


def sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, id_col="doc_id", text_col="text", rows=ROWS, chars=CHARS):
    """(ids, whole texts, labels) of at most `rows` rows of each class with at most `chars` characters in all, the first by a
    hash of the id, of which crc32(id) mod `folds` is not `held`. Unlabelled rows, null ids and repeated texts do not count."""
    known = labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("y")).filter(
        F.col("id").isNotNull() & F.col("y").isin(0, 1) & (crc_mod("id", folds) != held)
    )
    one = known.groupBy("id").agg(F.min("y").alias("y"))
    totals = {row["y"]: row["count"] for row in one.groupBy("y").count().collect()}  # two rows at most
    first = [first_by_hash(one.filter(F.col("y") == y), "id", rows, totals.get(y, 0)) for y in (0, 1)]
    read = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t"))
    found = texts_within(read, first[0].unionAll(first[1]), chars)
    unique = {row["t"]: row for row in sorted(found, key=lambda row: -row["id"])}
    kept = sorted(unique.values(), key=lambda row: row["id"])
    return [row["id"] for row in kept], [row["t"] for row in kept], np.array([row["y"] for row in kept], float)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, deviations and weights (the last one is the constant) of a ridge logistic regression, by Newton steps."""
    mean, deviation = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[(x - mean) / deviation, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = sigmoid(z @ w)
        w -= np.linalg.solve((z * (p * (1 - p) + 1e-6)[:, None]).T @ z + ridge * np.eye(len(w)), z.T @ (p - y) + ridge * w)
    return mean, deviation, w


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def scored(docs: DataFrame, function, folds: int, held: int, threshold: float, id_col="doc_id") -> DataFrame:
    """doc_id, held_out, score, predicted; `function` maps Arrow batches (id, t) to (doc_id, score)."""
    read = docs.select(F.col(id_col).cast("long").alias("id"), text_of("text").alias("t"))
    return read.mapInArrow(function, "doc_id long, score double").select(
        "doc_id", (crc_mod("doc_id", folds) == held).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def kept_rows(docs: DataFrame, function, text_col: str = "text", limit: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs, all columns, for which `function` (texts -> booleans) is true; a null text is given as the empty one.
    One pass, no shuffle; columns are told apart by place, so their names don't matter."""
    at = docs.columns.index(text_col)

    def each(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        from fringelake.llm.common import blocks

        for batch in batches:
            for part in blocks(batch, batch.schema.names[at], limit):
                texts = pc.fill_null(part.column(at), "").to_pylist()
                yield part.filter(pa.array(function(texts), pa.bool_()))

    return docs.mapInArrow(each, docs.schema)
