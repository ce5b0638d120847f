"""Byte-level BPE by prefix dynamic programming.

For each prefix of a byte string there is exactly one token that its encoding ends with; ``PrefixEncoder`` stores that
token for every prefix. The last token of a prefix is the one dictionary token that is a suffix of it and may follow the
last token of what stands before; whether two tokens may be neighbours (``Merges.may_follow``) depends only on the two.
So appending bytes extends the table and changes nothing in it, and after an edit the table is kept up to the edit and
rebuilt from there. Reading the table backwards gives the encoding, which is that of merging by rank.

The ranks and the pattern that cuts a text into pieces are parameters; pieces are encoded separately. Text is cut before
each single space that a non-space follows, where no piece can cross, so equal words are encoded once per worker and
looked up afterwards; a worker process remembers the words and the pieces that it met of late (``Memo``), from task to task.

Defined results: null text counts as empty; empty text has no ids; white space and very long words are pieces like any
other; a null id is kept; repeated rows each get their row; no rows in, no rows out; other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fringelake.llm.common import Memo, blocks, joined_by_row, kept, text_of

#: Words, and pieces, that each half of a worker's memory holds; bytes of text at once.
KNOWN, BLOCK = 150_000, 8 << 20
#: White_Space of Unicode, which is what \s means to the pattern's own engine.
_SPACE = r"\t-\r \x85\xa0  -     　"
#: Bytes that may begin a word after a space: none of white space, and not the first bytes of white space beyond ASCII.
_BEGINS = np.array([k > 32 and k != 127 and k not in (0xC2, 0xE1, 0xE2, 0xE3) for k in range(256)])


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def piece_pattern(pattern: str):
    import regex

    inside = re.sub(r"\[\^\\s", lambda _: f"[^{_SPACE}", pattern)
    return regex.compile(inside.replace(r"\s", f"[{_SPACE}]").replace(r"\S", f"[^{_SPACE}]"))


class Merges:
    """What follows from the ranks: the bytes of each id, the pair that each token is merged from, and which tokens may
    stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        self.token = {rank: token for token, rank in ranks.items()}
        self.base = base = max(self.token, default=0) + 1
        self.longest = max(map(len, ranks), default=0)
        #: The two parts of a merged token; -1 for single bytes.
        self.left, self.right = [-1] * base, [-1] * base
        #: left * base + right: the token that the two make.
        self.joined: dict[int, int] = {}
        #: Tokens that merging reaches, the only ones that an encoding holds.
        self.reached = {token: rank for token, rank in ranks.items() if len(token) == 1}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 1 and (pair := self._last_merge(ranks, token, rank)):
                self.left[rank], self.right[rank] = pair
                self.joined[pair[0] * base + pair[1]] = rank
                self.reached[token] = rank

    @staticmethod
    def _last_merge(ranks: dict[bytes, int], token: bytes, rank: int) -> tuple[int, int] | None:
        """The two tokens that merging by rank is left with before it makes `token`; None if it never makes it."""
        parts = [token[k : k + 1] for k in range(len(token))]
        while len(parts) > 2:
            best, k = min((ranks.get(parts[k] + parts[k + 1], rank), k) for k in range(len(parts) - 1))
            if best >= rank:
                return None
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return (ranks[parts[0]], ranks[parts[1]]) if all(p in ranks for p in parts) else None

    def may_follow(self, a: int, b: int) -> bool:
        """Whether merging by rank leaves the tokens a and b as they are when their bytes stand side by side.

        The merges on the two sides of the border are undone, the latest first. Had a pair across the border come before
        the merge that was just undone, it would have been merged instead; of equal ranks the left one comes first.
        """
        base, joined, left, right = self.base, self.joined.get, self.left, self.right
        undone_at = base + 1.0
        while True:
            across = joined(a * base + b)
            if across is not None and across < undone_at:
                return False
            if a > b and right[a] >= 0 or left[b] < 0:
                if right[a] < 0:
                    return True
                undone_at = a
                a = right[a]
            else:
                undone_at = b + 0.5
                b = left[b]


class PrefixEncoder:
    """The last token of every prefix of `data`, for exact appends and for re-encoding after an edit."""

    def __init__(self, merges: Merges, data: bytes = b""):
        self.merges, self.data, self.last = merges, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        merges, last = self.merges, self.last
        start, reached, follows, longest = len(self.data), merges.reached.get, merges.may_follow, merges.longest
        data = self.data = self.data + more
        for end in range(start + 1, len(data) + 1):
            for begin in range(end - longest if end > longest else 0, end):
                found = reached(data[begin:end])
                if found is not None and (begin == 0 or follows(last[begin - 1], found)):
                    last.append(found)
                    break
            else:
                raise ValueError(f"byte {data[end - 1]} has no rank")

    def replace(self, begin: int, end: int, by: bytes) -> None:
        """data[begin:end] becomes `by`; prefixes up to begin keep their tokens."""
        tail = by + self.data[end:]
        self.data = self.data[:begin]
        del self.last[begin:]
        self.append(tail)

    def ids(self) -> list[int]:
        out, end, token, last = [], len(self.data), self.merges.token, self.last
        while end:
            out.append(last[end - 1])
            end -= len(token[out[-1]])
        return out[::-1]


class TextEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers."""

    def __init__(self, merges: Merges, pattern: str):
        self.merges, self.pattern = merges, piece_pattern(pattern)
        self.known, self.known_pieces = Memo(KNOWN), Memo(KNOWN)
        self.bytes_of = pa.array([merges.token.get(i) for i in range(merges.base)], pa.binary())

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece. In sorted order neighbours share prefixes, whose part of the table stays as it is."""
        reached, found, table, shared = self.merges.reached.get, {}, PrefixEncoder(self.merges), commonprefix
        for data in sorted(piece.encode() for piece in pieces):
            whole = reached(data)
            if whole is None:
                begin = len(shared((table.data, data)))
                table.replace(begin, len(table.data), data[begin:])
                ids = table.ids()
            else:  # the table would end with this token, from the empty prefix
                ids = [whole]
            found[data] = array("I", ids).tobytes()
        return [found[piece.encode()] for piece in pieces]

    def _segments(self, segments: list[str]) -> list[bytes]:
        cut = list(map(self.pattern.findall, segments))
        distinct = list({piece for pieces in cut for piece in pieces})
        ids = dict(zip(distinct, self.known_pieces.of(distinct, self._pieces)))
        return [b"".join([ids[piece] for piece in pieces]) for pieces in cut]

    def encode_all(self, texts: pa.Array) -> list[memoryview]:
        """Texts are cut before each single space that a letter, digit or mark follows. Bytes that begin a white space of
        Unicode count as white space here: fewer cuts change nothing."""
        _, ends, data = texts.buffers()
        if data is None or not len(texts):
            return [memoryview(b"")] * len(texts)
        ends = np.frombuffer(ends, np.int32, len(texts) + 1, texts.offset * 4)
        low = int(ends[0])
        own = np.frombuffer(data, np.uint8)[low : int(ends[-1])]
        cut = np.zeros(len(own) + 1, bool)
        cut[1:-2] = (own[1:-1] == 32) & _BEGINS[own[2:]] & (own[:-2] != 32) if len(own) > 2 else False
        cut[ends - low] = True
        begins = np.flatnonzero(cut)
        segments = pa.Array.from_buffers(pa.string(), len(begins) - 1, [None, pa.py_buffer((begins + low).astype(np.int32)), data])
        coded = segments.dictionary_encode()
        ids = pa.array(self.known.of(coded.dictionary.to_pylist(), self._segments), pa.binary())
        return joined_by_row(coded, ids, np.searchsorted(begins, ends - low))

    def encode(self, text: str) -> bytes:
        return bytes(self.encode_all(pa.array([text], pa.string()))[0])

    def decode_all(self, ids: list[bytes]) -> list[memoryview]:
        sizes = np.array([len(x) // 4 for x in ids], np.int64)
        flat = np.frombuffer(b"".join(ids), "<u4")
        _, ends, data = self.bytes_of.take(pa.array(flat)).buffers()
        if data is None or not len(flat):
            return [memoryview(b"")] * len(ids)
        at = np.frombuffer(ends, np.int32)[np.r_[0, np.cumsum(sizes)]].tolist()
        whole = memoryview(data)
        return [whole[a:b] for a, b in zip(at, at[1:])]


def _encoder(merges, pattern: str) -> TextEncoder:
    """The encoder of this worker process; tasks that follow use its known words."""
    found = merges.value
    encoders = kept("bpe", found, dict)
    if pattern not in encoders:
        encoders[pattern] = TextEncoder(found, pattern)
    return encoders[pattern]


def _encoded(batches, merges, pattern):
    encoder = _encoder(merges, pattern)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    for batch in batches:
        for part in blocks(batch, "t", BLOCK):
            ids = encoder.encode_all(part.column("t"))
            n = pa.array([len(x) // 4 for x in ids], pa.int64())
            digests = [pa.array([hashlib.sha256(x).hexdigest() for x in many], pa.string()) for many in (ids, encoder.decode_all(ids))]
            yield pa.RecordBatch.from_arrays([part.column("id"), n, *digests], names=names)


def _as_ids(batches, merges, pattern):
    encoder = _encoder(merges, pattern)
    for batch in batches:
        for part in blocks(batch, "t", BLOCK):
            ids = [np.frombuffer(x, "<i4") for x in encoder.encode_all(part.column("t"))]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])


def _prepared(docs: DataFrame, path: str, id_col: str, text_col: str):
    merges = docs.sparkSession.sparkContext.broadcast(Merges(load_ranks(path)))
    return docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("t")), merges


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids, an array of ints."""
    read, merges = _prepared(docs, path, id_col, text_col)
    return read.mapInArrow(lambda batches: _as_ids(batches, merges, pattern), "doc_id long, ids array<int>")


def encode_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of what they decode to."""
    read, merges = _prepared(docs, path, id_col, text_col)
    return read.mapInArrow(
        lambda batches: _encoded(batches, merges, pattern), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def op9_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
