"""SimHash near-duplicates through a popcount embedding of the fingerprints.

A fingerprint is cut into 32 segments of two bits, and each segment is replaced by its number of ones, 0 to 2. The
Manhattan distance of two such vectors is never more than the Hamming distance of the fingerprints, so a range join on
the vectors loses no link. The join goes over a grid: of the two halves of the vector (16 segments each) one at least is
within half the bound, 2, and two lattice points at distance 2 have a common lattice point at distance 1 from both (or
are one step or none apart). So each fingerprint is entered, for each half, in its own cell and in those one step away,
about 50 rows, and every linked pair meets in a cell. Cells are sorted runs of a stream; candidates are verified on all
64 bits. A cell yields the edges of a spanning forest, found by a breadth-first search that compares with unvisited
members only, so a group of k near copies yields at most k - 1 edges a cell and never its pairs.

Documents with one fingerprint are one node, so exact copies never multiply. Components come from
``components.components``.

Defined results: null text counts as empty; a text without words has fingerprint 0, which is linked like any other;
fewer words than a shingle are one shingle; a null id takes part but names a component only if it has no other id;
repeated rows get equal results; no rows in, no rows out; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fringelake.llm.common import blocks, checkpointed, fresh, kept, numbered, text_of, without_rows
from fringelake.llm.components import components

#: Words in a shingle, seed of its hash, differing bits of a link.
SHINGLE, SEED, BITS = 4, 42, 4
_BYTE_ONES = np.uint64(0x0101010101010101)
_PAIR_ONES = np.uint64(0x5555555555555555)


def shingle_hashes(text: bytes, size: int = SHINGLE) -> list[int]:
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # of bytes: lowers A-Z only, splits at \x20\x09-\x0D only
    if len(words) <= size:
        return [xxh64_intdigest(b" ".join(words), SEED)] if words else []
    return [xxh64_intdigest(b" ".join(x), SEED) for x in zip(*(words[k:] for k in range(size)))]


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The fingerprint of each run of hashes; sizes are the runs' lengths. Ones are counted in eight byte lanes of a word,
    in chunks of 255 hashes at most, which no lane can overflow."""
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    n = sizes[full]
    chunks = -(-n // 255)
    first_chunk = np.cumsum(chunks) - chunks
    begins = np.repeat(np.cumsum(n) - n, chunks) + 255 * (np.arange(chunks.sum()) - np.repeat(first_chunk, chunks))
    found = np.zeros(len(full), np.uint64)
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & _BYTE_ONES, begins)
        counts = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first_chunk, axis=0)
        for byte in range(8):
            found |= (2 * counts[:, byte] > n).astype(np.uint64) << np.uint64(8 * byte + k)
    out[full] = found
    return out


def _fingerprinted(batches, size: int):
    kept("simhash", None, lambda: None)
    for batch in batches:
        for part in blocks(batch, "t"):
            each = [shingle_hashes(t, size) for t in part.column("t").cast(pa.binary()).to_pylist()]
            sizes = np.fromiter(map(len, each), np.int64, len(each))
            flat = np.fromiter((h for hs in each for h in hs), np.uint64, int(sizes.sum()))
            rest = [part.column(k) for k in range(part.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(majority(flat, sizes).view(np.int64))], names=[*part.schema.names[:-1], "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, row: str | None = None) -> DataFrame:
    """row (a number, or the column `row` of docs), id, fp (the 64 bits as a signed long)."""
    at = F.monotonically_increasing_id() if row is None else F.col(row)
    read = docs.select(at.alias("row"), F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("t"))
    schema = T.StructType([*read.schema.fields[:2], T.StructField("fp", T.LongType())])
    return read.mapInArrow(lambda batches: _fingerprinted(batches, size), schema)


def cells(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cell, place in fp) of every entry in the grid."""
    counts = (fp & _PAIR_ONES) + ((fp >> np.uint64(1)) & _PAIR_ONES)
    keys, places = [], []
    everyone = np.arange(len(fp))
    for half in range(2):
        own = ((counts >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        tag = np.int64(half) << 32
        keys.append(own | tag)
        places.append(everyone)
        for segment in range(16):
            level = (own >> (2 * segment)) & 3
            for step, may in ((1, level < 2), (-1, level > 0)):
                keys.append((own[may] + (np.int64(step) << (2 * segment))) | tag)
                places.append(everyone[may])
    return np.concatenate(keys), np.concatenate(places)


def _entered(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, 20_000):
            fp = batch.column(0).slice(start, 20_000).to_numpy(zero_copy_only=False)
            cell, place = cells(fp.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(fp[place])], names=["cell", "fp"])


def forest(fp: np.ndarray, bits: int = BITS) -> list[tuple[np.uint64, np.uint64]]:
    """Edges that connect exactly what links of `bits` or fewer differing bits connect among distinct fingerprints."""
    edges, left = [], fp
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            at = front.pop()
            near = np.bitwise_count(left ^ at) <= bits
            if near.any():
                found = left[near]
                edges += [(at, x) for x in found]
                front += list(found)
                left = left[~near]
    return edges


def _linked(batches, bits: int):
    """Edges from rows sorted by cell. Only the last run of a batch is carried on to the next."""

    def of(cell, fp):
        edges_a, edges_b = [], []
        begins = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        sizes = np.diff(np.r_[begins, len(cell)])
        pairs = begins[sizes == 2]
        near = pairs[np.bitwise_count(fp[pairs] ^ fp[pairs + 1]) <= bits] if len(pairs) else pairs
        edges_a.append(fp[near]), edges_b.append(fp[near + 1])
        more = sizes > 2
        for start, size in zip(begins[more].tolist(), sizes[more].tolist()):
            if found := forest(fp[start : start + size], bits):
                a, b = np.array(found, np.uint64).T
                edges_a.append(a), edges_b.append(b)
        a, b = np.concatenate(edges_a).view(np.int64), np.concatenate(edges_b).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    held_cell, held_fp = np.empty(0, np.int64), np.empty(0, np.uint64)
    for batch in batches:
        cell = np.concatenate([held_cell, batch.column(0).to_numpy(zero_copy_only=False)])
        fp = np.concatenate([held_fp, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
        if not len(cell):
            continue
        cut = int(np.searchsorted(cell, cell[-1]))
        if cut:
            yield of(cell[:cut], fp[:cut])
        held_cell, held_fp = cell[cut:], fp[cut:]
    if len(held_cell):
        yield of(held_cell, held_fp)


def links(distinct_fps: DataFrame, bits: int = BITS) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of at most `bits` (4 or fewer) differing bits."""
    if not 0 <= bits <= 4:
        raise ValueError("the grid is built for 4 or fewer differing bits")
    entered = distinct_fps.select("fp").mapInArrow(_entered, "cell long, fp long")
    sorted_cells = entered.repartition("cell").sortWithinPartitions("cell")
    return sorted_cells.mapInArrow(lambda batches: _linked(batches, bits), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, bits: int = BITS, row: str | None = None) -> DataFrame:
    """row, id, fp, component_id (the smallest id that links reach) and kept, true for one row of each component."""
    rows = checkpointed(fingerprints(docs, id_col, text_col, size, row))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first")
    nodes = checkpointed(rows.groupBy("fp").agg(first))
    joined = components(links(nodes, bits))
    named = nodes.join(joined.withColumnRenamed("node", "fp"), "fp", "left")
    linked = named.filter("component IS NOT NULL")
    lowest = linked.groupBy("component").agg(F.min("first").alias("first"))
    of_linked = linked.select("fp", "component").join(lowest, "component").select("fp", "first")
    of_fp = of_linked.unionAll(named.filter("component IS NULL").select("fp", "first"))
    return rows.join(of_fp, "fp").select("row", "id", "fp", F.col("first.id").alias("component_id"), (F.col("row") == F.col("first.row")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component."""
    row = fresh("row")
    docs = numbered(docs, row)
    dropped = checkpointed(near_duplicates(docs, id_col, text_col, row=row).filter(~F.col("kept")).select(F.col("row").alias(row)))
    return without_rows(docs, row, dropped, dropped.count()).drop(row)


def op3_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
