"""Best-fit packing: length patterns fitted to the histogram by non-negative least squares.

Documents become token pieces of at most ``LENGTH`` ids. Only the histogram of piece lengths, at most LENGTH numbers
however large the corpus, goes to the driver. There, patterns of few pieces that fill a sequence exactly are enumerated,
their repeat counts are fitted to the histogram (``nnls``) and rounded down, and what they leave is packed best-fit,
longest first, in runs of equal sequences. The plan says, for each length, which ordinals go to which sequences; it has a
few rows per length, so broadcasting it is bounded too. Each piece gets its ordinal among the pieces of its length from
counters per task, whose starts are summed up by a window over tasks; no task sees all pieces of a length.

Defined results: null or empty text is one piece that holds the end id only; a null id is kept; repeated rows each get
their pieces; pieces of full length stand alone; no rows in, no rows out; other columns are not looked at.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fringelake.llm.common import Memo, blocks, checkpointed, joined_by_row, kept, text_of

LENGTH, END = 2048, 0
#: Words that each half of a worker's memory holds, from task to task; words in a line for the tokenizer; bytes of text at once.
KNOWN, WORDS, BLOCK = 150_000, 200, 6 << 20
#: Patterns that are fitted, which is all of them at LENGTH; steps of the fit.
PATTERNS, STEPS = 400_000, 400


#: Letters that lower-casing keeps single, and marks that may end a word (fixed values).
_LETTERS, _MARKS = "A-Za-zÀ-ÖØ-öø-įı-ɏ", ".,;:!?"
_EMPTY = b""


class WordTokenizer:
    """Ids of texts by a tokenizer whose tokens never cross ASCII white space: each distinct word of a block is looked up once,
    and encoded only if it was not met of late (``Memo``). Where the tokenizer lower-cases and cuts letters from marks, words
    of letters are looked up in lower case and without the marks that end them."""

    def __init__(self, source: str):
        from tokenizers import Tokenizer

        self.source, self.tokenizer, self.known = source, Tokenizer.from_str(source), Memo(KNOWN)
        special = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special and not t.normalized}
        self.separator = max(special.items(), default=None)
        normalizer, cutter = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        self.folds = bool(normalizer and cutter) and normalizer.normalize_str("Ab") == "ab" and [p for p, _ in cutter.pre_tokenize_str("ab" + _MARKS)] == ["ab", _MARKS]

    def _encoded(self, words: list[str]) -> list[bytes]:
        """Ids of each word. Words go to the tokenizer in lines of WORDS with a special token between them."""
        encode = self.tokenizer.encode_batch_fast
        ids = lambda some: [np.array(code.ids, "<u4") for code in encode(some, add_special_tokens=False)]
        if self.separator is None:
            return [x.tobytes() for x in ids(words)]
        number, between = self.separator
        odd = [k for k, word in enumerate(words) if between in word]
        for k, own in zip(odd, ids([words[k] for k in odd])):
            words[k] = own
        plain = [k for k, word in enumerate(words) if isinstance(word, str)]
        for start in range(0, len(plain), WORDS):
            some = plain[start : start + WORDS]
            line = ids([between.join([words[k] for k in some])])[0]
            ends = np.append(np.flatnonzero(line == number), len(line)) * 4
            data, begin = line.tobytes(), 0
            for k, end in zip(some, ends.tolist(), strict=True):
                words[k] = data[begin:end]
                begin = end + 4
        return [bytes(word) if isinstance(word, bytes) else word.tobytes() for word in words]

    def _of_words(self, words: pa.Array) -> pa.Array:
        """The ids of distinct words."""
        if not self.folds:
            return pa.array(self.known.of(words.to_pylist(), self._encoded), pa.binary())
        core = pc.utf8_rtrim(words, characters=_MARKS)
        plain = pc.match_substring_regex(core, f"^[{_LETTERS}]+$")
        key = pc.if_else(plain, pc.ascii_lower(core), words)
        tail = pc.if_else(plain, pc.replace_substring_regex(words, f"^[{_LETTERS}]+", ""), "")
        units = pa.concat_arrays([key, tail]).dictionary_encode()
        ids = pa.array(self.known.of(units.dictionary.to_pylist(), self._encoded), pa.binary())
        return pc.binary_join_element_wise(ids.take(units.indices[: len(words)]), ids.take(units.indices[len(words) :]), _EMPTY)

    def encode_all(self, texts: pa.Array) -> list[memoryview]:
        cut = pc.ascii_split_whitespace(texts)
        words = cut.flatten().dictionary_encode()
        offsets = cut.offsets.to_numpy()
        return joined_by_row(words, self._of_words(words.dictionary), offsets - offsets[0])


def _tokenizer(source) -> WordTokenizer:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    text = source.value
    return kept("packing", text, lambda: WordTokenizer(text))


_PIECES = "id long, piece int, start long, length long, ids_crc32 long, task int, ordinal long"


def _cut(batches, source, length: int, end: int):
    tokenizer, task = _tokenizer(source), TaskContext.get().partitionId()
    seen = np.zeros(length + 1, np.int64)
    last, whole = end.to_bytes(4, "little"), 4 * length
    names = [c.split()[0] for c in _PIECES.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    for batch in batches:
        for part in blocks(batch, "t", BLOCK):
            rows = []
            coded = tokenizer.encode_all(part.column("t"))
            for doc, ids in zip(part.column("id").to_pylist(), coded):
                ids = memoryview(bytes(ids) + last)
                for piece, begin in enumerate(range(0, len(ids), whole)):
                    some = ids[begin : begin + whole]
                    n = len(some) // 4
                    rows.append((doc, piece, begin // 4, n, zlib.crc32(some), task, int(seen[n])))
                    seen[n] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def pieces(docs: DataFrame, path: str, length: int = LENGTH, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of every document, with the ordinal of each among those of its length in its task."""
    with open(path, encoding="utf-8") as file:
        source = docs.sparkSession.sparkContext.broadcast(file.read())
    read = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("t"))
    return read.mapInArrow(lambda batches: _cut(batches, source, length, end), _PIECES)


def patterns(counts: np.ndarray, length: int, limit: int = PATTERNS) -> np.ndarray:
    """Sets of two and three lengths with sum `length`, all of them present; missing third lengths are 0. Beyond `limit`
    the triples are thinned evenly, which costs fill and loses no piece."""
    there = np.flatnonzero(counts[:length])
    there = there[there > 0]
    has = np.zeros(length + 1, bool)
    has[there] = True
    small = there[2 * there <= length]
    pairs = small[has[length - small]]
    found = [np.c_[length - pairs, pairs, np.zeros_like(pairs)]]
    a, b = np.meshgrid(there[3 * there <= length], there, indexing="ij")
    c = length - a - b
    ok = (a <= b) & (b <= c)
    ok[ok] &= has[c[ok]]
    triples = np.c_[c[ok], b[ok], a[ok]]
    if len(triples) > limit:
        triples = triples[np.linspace(0, len(triples) - 1, limit).astype(np.int64)]
    return np.concatenate([*found, triples]).astype(np.int64)


def nnls(sets: np.ndarray, counts: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Repeat counts x >= 0 that minimise the squared distance of the lengths used to `counts`, by accelerated projected
    gradient. sets: as of ``patterns``; column 0 of the histogram stands for "none" and is not fitted."""
    if not len(sets):
        return np.zeros(0)
    used = np.bincount(sets.ravel(), minlength=len(counts)).astype(float)
    used[0] = 0
    target = counts.astype(float)
    # Each pattern's step is bounded by how many patterns share its lengths (a diagonal majoriser of the quadratic).
    weight = np.where(sets > 0, used[sets], 0)
    step = 1 / (3 * weight.max(axis=1))
    x = y = np.zeros(len(sets))
    momentum = 1.0
    for _ in range(steps):
        fit = np.bincount(sets.ravel(), np.repeat(y, sets.shape[1]), minlength=len(counts))
        gap = fit - target
        gap[0] = 0
        ahead = np.maximum(0, y - step * gap[sets].sum(axis=1))
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        y = ahead + (momentum - 1) / after * (ahead - x)
        x, momentum = ahead, after
    return x


class Plan:
    """Runs of equal sequences: which ordinals of each length go to which sequences, at which place."""

    def __init__(self, counts: np.ndarray, length: int = LENGTH):
        self.length, self.sequences = length, 0
        self.left = counts.astype(np.int64).copy()
        self.taken = np.zeros_like(self.left)
        self.slots: list[tuple[int, int, int, int]] = []  # length, first ordinal, first sequence, offset
        self._alone()
        sets = patterns(self.left, length)
        x = nnls(sets, self.left)
        self._repeat(sets, x)
        self._best_fit()

    def _take(self, size: int, n: int, sequence: int, offset: int) -> None:
        self.slots.append((size, int(self.taken[size]), sequence, offset))
        self.taken[size] += n
        self.left[size] -= n

    def _alone(self) -> None:
        n = int(self.left[self.length])
        if n:
            self._take(self.length, n, self.sequences, 0)
            self.sequences += n

    def _repeat(self, sets: np.ndarray, x: np.ndarray) -> None:
        # Rounded to the nearest count, but no more than what is left: a pattern that is short of a piece is cut back.
        for k in np.argsort(-x, kind="stable"):
            if x[k] < 0.5:
                break
            sizes = [int(s) for s in sets[k] if s]
            n = min([int(round(x[k])), *(int(self.left[s]) // sizes.count(s) for s in sizes)])
            if n:
                offset = 0
                for s in sizes:
                    self._take(s, n, self.sequences, offset)
                    offset += s
                self.sequences += n

    def _best_fit(self) -> None:
        room: dict[int, list[tuple[int, int]]] = {}  # free ids: runs (first sequence, sequences)
        for size in range(self.length - 1, 0, -1):
            while n := int(self.left[size]):
                free = min((r for r in room if r >= size), default=0)
                if free:
                    first, many = room[free].pop()
                    if not room[free]:
                        del room[free]
                    if many > n:
                        room.setdefault(free, []).append((first + n, many - n))
                        many = n
                else:
                    first, many, free = self.sequences, -(-n // (self.length // size)), self.length
                    self.sequences += many
                self._take(size, min(n, many), first, self.length - free)
                if free > size:
                    room.setdefault(free - size, []).append((first, min(n, many)))
                if many > n:  # only for new sequences that did not get a piece
                    self.sequences -= many - n

    def lookup(self) -> dict[int, np.ndarray]:
        """For each length: first ordinals, first sequences, offsets, by ordinal."""
        by: dict[int, list] = {}
        for size, *rest in self.slots:
            by.setdefault(size, []).append(rest)
        return {size: np.array(sorted(rows), np.int64).T for size, rows in by.items()}


def _placed(batches, plan):
    slots = plan.value
    for batch in batches:
        columns = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
        sizes = columns["length"].to_numpy(zero_copy_only=False)
        ordinals = columns["ordinal"].to_numpy(zero_copy_only=False)
        sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        order = np.argsort(sizes, kind="stable")
        begins = np.flatnonzero(np.r_[True, np.diff(sizes[order]) != 0]) if len(order) else []
        for rows in np.split(order, begins[1:]) if len(order) else []:
            first, sequences, offsets = slots[int(sizes[rows[0]])]
            slot = np.searchsorted(first, ordinals[rows], side="right") - 1
            sequence[rows] = sequences[slot] + ordinals[rows] - first[slot]
            offset[rows] = offsets[slot]
        keep = ["id", "piece", "start", "length", "ids_crc32"]
        yield pa.RecordBatch.from_arrays(
            [*(columns[c] for c in keep), pa.array(sequence), pa.array(offset)], names=["doc_id", *keep[1:], "sequence_id", "offset"]
        )


def pack(cut: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    cut = checkpointed(cut)
    per_task = cut.groupBy("task", "length").agg(F.count("*").alias("n"))
    counts = np.zeros(length + 1, np.int64)
    for row in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # `length` rows at most
        counts[row["length"]] = row["n"]
    plan = cut.sparkSession.sparkContext.broadcast(Plan(counts, length).lookup())
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    numbered = cut.join(starts, ["task", "length"]).withColumn("ordinal", F.col("ordinal") + F.col("before"))
    return numbered.select("id", "piece", "start", "length", "ids_crc32", "ordinal").mapInArrow(
        lambda batches: _placed(batches, plan),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )


def pack_documents(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return pack(pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


def op6_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
