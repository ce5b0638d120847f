"""What the corpus operators share: text columns, row ids, checkpoints and bounded joins."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Java and RE2 form of the words and of the white space between them.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of eight-byte keys that may be broadcast: 2 million are about 16 MB before hashing.
BROADCAST_ROWS = 2_000_000
#: Text bytes that a Python worker holds at once, besides one row longer than that.
BLOCK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text"):
    """A text column in which null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fold_space(column):
    """Each run of ASCII white space as one space; single spaces are not touched, which is most of them."""
    return F.regexp_replace(column, r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def crc_mod(column: str, n: int):
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def fresh(name: str) -> str:
    """A column name that no input has."""
    return f"__{name}_{uuid.uuid4().hex[:8]}"


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, which all executors share. Where none is set, a folder of the warehouse
    is set instead on a local master (tests, one machine), and anything else is an error: executors would not see it."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints")
    return context._jsc.sc().getCheckpointDir().get()


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of the shared store."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def first_by_hash(df: DataFrame, id_col: str, n: int, total: int) -> DataFrame:
    """The n rows whose ids have the smallest hashes, of about `total`. Rows beyond a hash that 4 n rows are expected to lie
    below are filtered where they are read, so that the driver gets about 4 n rows however many tasks there are; where so many
    ids are alike that fewer than n lie below it, all rows are ordered."""
    if total > 4 * n:
        below = df.filter(F.xxhash64(id_col) <= int(-(2**63) + 4 * n / total * 2**64))
        if below.limit(n).count() == n:
            df = below
    return df.orderBy(F.xxhash64(id_col), id_col).limit(n)


def within(lengths: list[int], most: int) -> list[int]:
    """Places of the texts that are taken, in order: those that still fit; a text longer than what is left is passed over."""
    taken, total = [], 0
    for k, n in enumerate(lengths):
        if total + n <= most:
            taken.append(k)
            total += n
    return taken


def texts_within(read: DataFrame, chosen: DataFrame, chars: int) -> list:
    """Rows (id, y, t) of whole texts: of each y those of the `chosen` ids (a bounded number of rows id, y) that come first by a
    hash of the id and have at most `chars` characters in all. read: rows id, t; of several texts of an id the least counts."""
    chosen = F.broadcast(chosen)
    lengths = read.select("id", F.char_length("t").alias("n")).join(chosen, "id").groupBy("id", "y").agg(F.max("n").alias("n"))
    measured = lengths.orderBy(F.xxhash64("id"), "id").collect()
    taken = []
    for y in sorted({row["y"] for row in measured}):
        of_class = [row for row in measured if row["y"] == y]
        taken += [(of_class[k]["id"], y) for k in within([row["n"] for row in of_class], chars)]
    schema = T.StructType([read.schema["id"], T.StructField("y", T.IntegerType())])
    picked = F.broadcast(read.sparkSession.createDataFrame(taken, schema))
    return read.join(picked, "id").groupBy("id", "y").agg(F.min("t").alias("t")).collect()  # `chars` characters of each y at most


def _from_files(docs: DataFrame) -> bool:
    """Whether docs is a file source under projections and filters alone, so that each row is one row of a file."""
    node = docs._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().head()
    return node.nodeName() == "LogicalRelation"


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """docs with a column `name` that tells its rows apart and is the same whenever they are read, however the files are
    split: the digest of the file's name and the row's place in the file. Rows that are not read from (distinct) Parquet files
    are written to the checkpoint folder with a running number instead."""
    if _from_files(docs):
        try:
            file = docs.metadataColumn("_metadata")
            return docs.withColumn(name, F.struct(F.unhex(F.md5(file["file_path"])).alias("file"), file["row_index"].alias("at")))
        except AnalysisException:  # a file source without row numbers
            pass
    return checkpointed(docs.withColumn(name, F.monotonically_increasing_id()))


def salted_join(rows: DataFrame, side: DataFrame, on: list[str], salt_by: str, how: str = "inner", salts: int = 16) -> DataFrame:
    """rows joined with side, which has one row per key: the rows of each key are dealt over `salts` tasks by `salt_by`, so that a
    key with a third of all rows is no task of its own."""
    salt = fresh("salt")
    dealt = rows.withColumn(salt, F.pmod(F.xxhash64(salt_by), F.lit(salts)))
    copied = side.withColumn(salt, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return dealt.join(copied, [*on, salt], how).drop(salt)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows, written to the shared checkpoint folder, so that a lost executor costs no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def without_rows(docs: DataFrame, row_id: str, dropped: DataFrame, n_dropped: int) -> DataFrame:
    """docs less the rows whose row_id is in dropped: a broadcast of the ids if they are few, else a shuffle join."""
    side = F.broadcast(dropped) if n_dropped <= BROADCAST_ROWS else dropped
    return docs.join(side, row_id, "left_anti")


class Memo:
    """Results by key, of which those used of late are kept: a key met again moves to the young half, and when that has more
    than `size` keys it becomes the old half, whose other keys are forgotten. So common words stay, and words that occur once
    do not push them out."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def of(self, keys: list, compute) -> list:
        """The result of each of the distinct keys; `compute` maps a list of new keys to theirs."""
        young, old = self.young, self.old
        found = list(map(young.get, keys))
        new = []
        for k, value in enumerate(found):
            if value is None:
                key = keys[k]
                value = found[k] = old.get(key)
                if value is None:
                    new.append(k)
                else:
                    young[key] = value
        for k, value in zip(new, compute([keys[k] for k in new])):
            found[k] = young[keys[k]] = value
        if len(young) > self.size:
            self.old, self.young = young, {}
        return found


def joined_by_row(parts, of_unique, offsets) -> list[memoryview]:
    """For each row the concatenation of its parts' results. parts: a dictionary-encoded Arrow array; of_unique: a binary array
    with the result of each entry of its dictionary; offsets: where each row's parts begin, and the end."""
    import numpy as np

    laid = of_unique.take(parts.indices)
    _, ends, data = laid.buffers()
    if data is None or not len(laid):
        return [memoryview(b"")] * (len(offsets) - 1)
    at = np.frombuffer(ends, np.int32, len(laid) + 1, laid.offset * 4)[np.asarray(offsets)].tolist()
    whole = memoryview(data)
    return [whole[a:b] for a, b in zip(at, at[1:])]


#: What this worker process keeps from task to task: of one operator at a time, (owner, key, value).
_KEPT: list[tuple] = []


def kept(owner: str, key, make):
    """The value that `make` gives for the key, which must stay alive as long as it is asked for (a broadcast's value); what
    another operator kept in this worker is dropped, so that memory holds one operator's models and words at a time."""
    if not _KEPT or _KEPT[0][0] != owner or _KEPT[0][1] is not key:
        _KEPT.clear()
        give_back()
        _KEPT.append((owner, key, make()))
    return _KEPT[0][2]


def give_back() -> None:
    """Returns to the system what Arrow and the C library hold on to after large blocks."""
    import ctypes
    import gc

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        trim = ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # only some C libraries have it
        return
    gc.collect(0)
    trim(0)


def blocks(batch, column: str, limit: int = BLOCK_BYTES):
    """Slices of an Arrow batch with about `limit` bytes of text each; a longer row stands alone. After the last one the worker
    gives back what memory Arrow holds on to."""
    import numpy as np
    import pyarrow.compute as pc

    if not batch.num_rows:
        return
    text = batch.column(batch.schema.get_field_index(column))
    sizes = np.asarray(pc.fill_null(pc.binary_length(text), 0))
    ends = np.cumsum(sizes)
    start, base = 0, 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start, base = stop, int(ends[stop - 1])
    give_back()
