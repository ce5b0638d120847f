"""LM scoring: a gated recurrent network over words with a class-factored output.

The counts of every word of every training text are taken with Spark and cover the whole corpus. The network is numpy:
a gated recurrent layer whose state is carried through a document from its first word to its end, so that the score is the
log-likelihood of the complete text. P(word) = P(class | state) * P(word | class, state): frequent words are in classes of
SIZE members, whose softmax sees the state; every other word is in a class that its spelling chooses, in which its share is
its corpus count, with one count for unseen words.

The classes by spelling are learned from all training texts: how the TELLING commonest words meet in texts is summed over
them and groups these words, the words group the texts, and pieces of spelling are counted by group of texts.

The network is trained by truncated backpropagation (windows of STEPS words, the state carried on from window to window)
over all training texts, in rounds that grow: the blocks of the first are trained on in one task, from blank weights; in each
next round, of MORE times the blocks of all before, every task goes on from the weights so far over its blocks of the round, and
the tasks' weights are averaged by the number of words that they saw. Every block is in one round, so no text is left out.
What is sent to the driver of that is PARTS sums a round, whatever the number of tasks.

No vocabulary is held anywhere as a whole. Texts are read once, into blocks of about BLOCK bytes: each block is written
(checkpointed) as codes of its own word list. The lists meet in one table of counts by a shuffle on the word, which counts
partially first, and each block gets the counts of its own words back by a join; blocks are then scored alone. A hot word
is one row for each block in that join.

Defined results: null text counts as empty; an empty text is its end token; a null id is held out or not like the empty
text; repeated rows count as often as they occur and get equal scores; without training texts every score is that of the
empty model, 0; no rows in, no rows out; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fringelake.llm.common import blocks, checkpointed, crc_mod, text_of

FOLDS, HELD = 7, 2
#: Bytes of text in a block, and words in a row of its list.
BLOCK, LIST = 24 << 20, 20_000
#: Words that group texts, texts that are grouped at once, and pieces of spelling, the commonest, that the model has.
TELLING, AT_ONCE, PIECES = 400, 2000, 60_000
#: Bytes of coded documents in the first round of training at least, and times those of all rounds before in each next one.
FIRST, MORE = 4 << 20, 7
#: Streams of texts side by side, and first step, beyond the first round; sums of weights that reach the driver.
WIDE, FINE, PARTS = 512, 0.008, 16
#: The end token, which no word can be: words hold no space.
END = " "
MARKS = ".,;:!?"
HIDDEN, CLASSES, SIZE, GROUPS, LEAST = 16, 32, 40, 6, 3
STEPS, LANES, WINDOWS, PASSES, RATE, CLIP = 32, 64, 500, 2, 0.015, 1.0


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


# ---- spelling ----------------------------------------------------------------------------------------------------------


def spelling(word: str) -> tuple[str, ...]:
    """What of its spelling chooses a rare word's class."""
    core = word.strip(MARKS)
    return f"^{core[:2]}", f"{core[-2:]}$", f"*{core[1:4]}", f"#{core[-4:-1]}", f"{word[-3:]}|"


def _pieces(words: pa.Array):
    """The five pieces of ``spelling`` of many words, kind by kind: what stands before them, they, and what stands after them."""
    core = pc.utf8_trim(words, characters=MARKS)
    cut = pc.utf8_slice_codeunits
    yield from (("^", cut(core, 0, 2), ""), ("", cut(core, -2), "$"), ("*", cut(core, 1, 4), ""), ("#", cut(core, -4, -1), ""), ("", cut(words, -3), "|"))


def _piece_counts(words: pa.Array, counts: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Pieces of the words, and how often texts of each group have them. counts: of each word, by group."""
    names, numbers = [], []
    for before, pieces, after in _pieces(words):
        told = pieces.dictionary_encode()
        at = told.indices.to_numpy()
        names.append(pc.binary_join_element_wise(before, told.dictionary, after, ""))
        numbers.append(np.column_stack([np.bincount(at, counts[:, g], len(told.dictionary)) for g in range(GROUPS)]))
    return pa.concat_arrays(names), np.concatenate(numbers)


def _places(words: pa.Array, telling: list[str]) -> np.ndarray:
    """Place of each word among the telling ones; their number for others."""
    return pc.fill_null(pc.index_in(words, value_set=pa.array(telling, pa.string())), len(telling)).to_numpy(zero_copy_only=False)


def _profiles(sizes: np.ndarray, codes: np.ndarray, place: np.ndarray, many: int):
    """Of AT_ONCE texts at a time, the roots of their counts of the telling words, and of all others together, to length 1."""
    ends = np.cumsum(sizes)
    for first in range(0, len(sizes), AT_ONCE):
        n = sizes[first : first + AT_ONCE]
        begin = ends[first] - n[0]
        at = np.repeat(np.arange(len(n)) * (many + 1), n) + place[codes[begin : begin + n.sum()]]
        x = np.sqrt(np.bincount(at, minlength=len(n) * (many + 1)).reshape(len(n), -1).astype(np.float32))
        yield x / np.linalg.norm(x, axis=1, keepdims=True)


def _moment(sizes, codes, place, many: int) -> np.ndarray:
    """How the telling words meet in the texts: the sum of the products of profiles."""
    return sum((x.T @ x for x in _profiles(sizes, codes, place, many)), np.zeros((many + 1, many + 1)))


def _centres(moment: np.ndarray) -> np.ndarray:
    """Weight of each telling word in each group. The words are grouped by the leading directions of their correlations
    (k-means from words far apart); a group weighs its words alike, by how much of them texts have."""
    many = len(moment) - 1
    out = np.zeros((many + 1, GROUPS), np.float32)
    if not many:
        return out
    met = moment[:-1, :-1]
    size = np.sqrt(np.maximum(np.diag(met), 1e-9))
    x = np.linalg.eigh(met / np.outer(size, size))[1][:, ::-1][:, :GROUPS]
    x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    centres = x[:1]
    while len(centres) < min(GROUPS, many):
        centres = np.vstack([centres, x[(x @ centres.T).max(axis=1).argmin()]])
    for _ in range(30):
        own = (x @ centres.T).argmax(axis=1)
        centres = np.array([x[own == g].sum(axis=0) if (own == g).any() else centres[g] for g in range(len(centres))])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
    for g in range(len(centres)):
        k = np.flatnonzero(own == g)
        out[k, g] = max(met[np.ix_(k, k)].sum(), 1e-9) ** -0.5
    return out


def _word_groups(sizes, codes, place, centres: np.ndarray, many_words: int) -> np.ndarray:
    """Counts of each word (code) in the texts of each group; the end is not counted."""
    groups = [(x @ centres).argmax(axis=1) for x in _profiles(sizes, codes, place, len(centres) - 1)]
    own = np.repeat(np.concatenate(groups), sizes) if groups else np.zeros(0, np.int64)
    counts = np.bincount(codes * np.int64(GROUPS) + own, minlength=many_words * GROUPS).reshape(-1, GROUPS)
    counts[0] = 0
    return counts


@dataclass
class Speller:
    """Log odds of each group of texts by a piece of spelling."""

    table: dict[str, np.ndarray]
    prior: np.ndarray

    @staticmethod
    def of_counts(pieces: list[str], counts: np.ndarray, total: np.ndarray) -> Speller:
        """From the counts of pieces, and of all words, by group of texts."""
        prior = (total + 1) / (total + 1).sum()
        odds = np.log((counts + 2 * prior) / (counts.sum(axis=1, keepdims=True) + 2)) - np.log(prior)
        return Speller(dict(zip(pieces, odds)), np.log(prior))

    def __post_init__(self):
        self.kinds_of = {}  # what stands before and after -> its pieces, and their odds
        for before, after in (("^", ""), ("", "$"), ("*", ""), ("#", ""), ("", "|")):
            own = [p for p in self.table if p.startswith(before) and p.endswith(after)]
            self.kinds_of[before, after] = pa.array([p[len(before) : len(p) - len(after)] for p in own], pa.string()), np.vstack([*(self.table[p] for p in own), np.zeros(GROUPS)])

    def groups(self, words: pa.Array) -> np.ndarray:
        odds = np.tile(self.prior, (len(words), 1))
        for before, pieces, after in _pieces(words):
            known, own = self.kinds_of[before, after]
            odds += own.take(pc.fill_null(pc.index_in(pieces, value_set=known), len(known)).to_numpy(zero_copy_only=False), axis=0)
        return odds.argmax(axis=1)

    def kinds(self, words: pa.Array) -> np.ndarray:
        """Rare class of each word, from 0 to 3 * GROUPS - 1: by its group and by how it ends."""
        last = pc.utf8_slice_codeunits(words, -1)
        marked = pc.if_else(pc.is_in(last, value_set=pa.array(list(".,;"))), 1, 2)
        return 3 * self.groups(words) + pc.if_else(pc.utf8_is_alpha(last), 0, marked).to_numpy(zero_copy_only=False)


# ---- the network -------------------------------------------------------------------------------------------------------


class Steps:
    """Adam with clipped slopes and a rate that falls."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.weights, self.rate, self.n = weights, rate, 0
        self.first, self.second = ({k: np.zeros_like(v) for k, v in weights.items()} for _ in range(2))

    def take(self, slopes: dict[str, np.ndarray]) -> None:
        self.n += 1
        norm = sum(float((g * g).sum()) for g in slopes.values()) ** 0.5
        rate = self.rate * min(1.0, CLIP / max(norm, 1e-9)) / (1 + self.n / 400) ** 0.5 / (1 - 0.9**self.n)
        scale = np.float32((1 - 0.99**self.n) ** -0.5)
        for k, g in slopes.items():
            first, second = self.first[k], self.second[k]
            first += 0.1 * (g - first)
            second += 0.01 * (g * g - second)
            self.weights[k] -= np.float32(rate) * first / (np.sqrt(second) * scale + 1e-6)


@dataclass
class Network:
    """Input ids: 0 the end, 1.. frequent words, then one for each rare class. Output classes: 0 the end, CLASSES of frequent
    words, 3 * GROUPS rare ones."""

    frequent: dict[str, int]  # word -> input id
    class_of: np.ndarray  # input id -> output class
    member_of: np.ndarray  # input id -> place in the class; -1 outside frequent classes
    members: np.ndarray  # output class -> its number of frequent words
    weights: dict[str, np.ndarray]
    #: Whether exponents need no shift (``_bounded``), known once the weights are final.
    bounded: bool = False

    @staticmethod
    def blank(frequent: list[str], speller: Speller, seed: int = 5) -> Network:
        frequent = frequent[: CLASSES * SIZE]
        order = np.argsort(speller.groups(pa.array(frequent, pa.string())), kind="stable").tolist()
        n = len(frequent) + 1 + 3 * GROUPS
        class_of, member_of = np.zeros(n, np.int64), np.full(n, -1, np.int64)
        for rank, k in enumerate(order):
            class_of[k + 1], member_of[k + 1] = 1 + rank // SIZE, rank % SIZE
        class_of[len(frequent) + 1 :] = 1 + CLASSES + np.arange(3 * GROUPS)
        draw, c = np.random.default_rng(seed), 1 + CLASSES + 3 * GROUPS
        normal = lambda *shape, by=0.1: draw.normal(0, by, shape).astype(np.float32)
        weights = {
            "in": normal(n, 3 * HIDDEN), "u": normal(HIDDEN, 3 * HIDDEN, by=HIDDEN**-0.5), "c": normal(HIDDEN, c), "cb": np.zeros(c, np.float32),
            "m": normal(CLASSES, SIZE, HIDDEN), "mb": np.zeros((CLASSES, SIZE), np.float32),
        }
        members = np.bincount(class_of[1 : len(frequent) + 1], minlength=c)
        return Network({w: k + 1 for k, w in enumerate(frequent)}, class_of, member_of, members, weights)

    def inputs(self, words: pa.Array, speller: Speller) -> np.ndarray:
        """Input id of each word."""
        known = pc.index_in(words, value_set=pa.array(list(self.frequent), pa.string()))
        rare = pc.is_null(known).to_numpy(zero_copy_only=False)
        out = pc.fill_null(known, 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        out[rare] = len(self.frequent) + 1 + speller.kinds(words.filter(pa.array(rare)))
        out[pc.equal(words, END).to_numpy(zero_copy_only=False)] = 0
        return out

    def step(self, h, ids):
        """The next state, and what backpropagation needs."""
        a, u = self.weights["in"].take(ids, axis=0), h @ self.weights["u"]
        gates = a[:, : 2 * HIDDEN]
        gates += u[:, : 2 * HIDDEN]
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        z, r, n = gates[:, :HIDDEN], gates[:, HIDDEN:], a[:, 2 * HIDDEN :]
        n += r * u[:, 2 * HIDDEN :]
        np.tanh(n, out=n)
        return n + z * (h - n), (h, z, r, n, u[:, 2 * HIDDEN :])

    def class_log(self, h):
        """Log-probabilities of the classes."""
        x = h @ self.weights["c"] + self.weights["cb"]
        if not self.bounded:
            x -= x.max(axis=1, keepdims=True)
        return x - np.log(np.exp(x).sum(axis=1, keepdims=True))

    def chosen_log(self, h, classes):
        """Log-probability of one class for each state."""
        x = h @ self.weights["c"] + self.weights["cb"]
        if not self.bounded:
            x -= x.max(axis=1, keepdims=True)
        own = x[np.arange(len(x)), classes]
        return own - np.log(np.exp(x, out=x).sum(axis=1))

    def member_log(self, h, ids):
        """Log-probability of each frequent word in its class, given the state."""
        out = np.zeros(len(ids), np.float32)
        classes = self.class_of[ids]
        order = np.argsort(classes, kind="stable")
        begins = np.flatnonzero(np.r_[True, np.diff(classes[order]) != 0]) if len(order) else []
        for rows in np.split(order, begins[1:]) if len(order) else []:
            k = int(classes[rows[0]]) - 1
            n = int(self.members[k + 1])
            x = h[rows] @ self.weights["m"][k, :n].T + self.weights["mb"][k, :n]
            if not self.bounded:
                x -= x.max(axis=1, keepdims=True)
            own = x[np.arange(len(rows)), self.member_of[ids[rows]]]
            out[rows] = own - np.log(np.exp(x, out=x).sum(axis=1))
        return out

    def train(self, texts: np.ndarray, last: bool = True, seed: int = 11) -> None:
        """The first round, from blank weights: PASSES over texts that each end with 0, each in another order, and one of finer
        steps if no other round follows."""
        draw, steps = np.random.default_rng(seed), Steps(self.weights, RATE)
        ends = np.flatnonzero(texts == 0) + 1
        sizes = np.diff(ends, prepend=0)
        lanes = min(WIDE, max(LANES, len(texts) // (WINDOWS * STEPS)))
        for _ in range(PASSES):
            order = draw.permutation(len(ends))
            moved = (ends - sizes)[order] - (np.cumsum(sizes[order]) - sizes[order])
            self.over(texts[np.repeat(moved, sizes[order]) + np.arange(len(texts))], steps, lanes)
        if last:
            self.over(texts, Steps(self.weights, FINE), WIDE)
        self.settle()

    def over(self, flat: np.ndarray, steps: Steps, most: int) -> None:
        """One pass over texts that each end with 0, in windows of STEPS words over at most `most` lanes; the state goes on from
        window to window and starts at zero where a text does. Lanes are padded with ends to equal length."""
        flat = np.r_[0, flat]
        lanes = min(most, max(1, (len(flat) - 1) // (2 * STEPS)))
        length = -(-(len(flat) - 1) // lanes)
        flat = np.r_[flat, np.zeros(lanes * length + 1 - len(flat), flat.dtype)]
        inputs, targets = flat[:-1].reshape(lanes, length), flat[1:].reshape(lanes, length)
        h = np.zeros((lanes, HIDDEN), np.float32)
        for begin in range(0, length, STEPS):
            h, slopes = self._window(h, inputs[:, begin : begin + STEPS], targets[:, begin : begin + STEPS])
            steps.take(slopes)

    def _bounded(self) -> bool:
        """Whether no class and no member can get an exponent beyond 60, as states are within -1 and 1."""
        w = self.weights
        return bool(max((np.abs(w["c"]).sum(axis=0) + np.abs(w["cb"])).max(), (np.abs(w["m"]).sum(axis=2) + np.abs(w["mb"])).max()) < 60)

    def settle(self) -> None:
        """To be called when the weights are final."""
        self.bounded = self._bounded()

    def _window(self, h, x, y):
        w, lanes, steps = self.weights, x.shape[0], x.shape[1]
        held, states, starts = [], [], []
        for t in range(steps):
            goes_on = (x[:, t] != 0).astype(np.float32)[:, None]
            h, kept = self.step(h * goes_on, x[:, t])
            held.append(kept), states.append(h), starts.append(goes_on)
        all_h, all_y = np.concatenate(states), y.T.ravel()
        classes, scale = self.class_of[all_y], np.float32(1 / len(all_y))
        p, bounded = all_h @ w["c"], self._bounded()
        p += w["cb"]
        if not bounded:
            p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(p)), classes] -= 1
        p *= scale
        g = {k: np.zeros_like(v) for k, v in w.items()}
        g["c"], g["cb"] = all_h.T @ p, p.sum(axis=0)
        dh_all = p @ w["c"].T
        frequent = np.flatnonzero(self.member_of[all_y] >= 0)
        order = frequent[np.argsort(classes[frequent], kind="stable")]
        begins = np.flatnonzero(np.r_[True, np.diff(classes[order]) != 0]) if len(order) else []
        for rows in np.split(order, begins[1:]) if len(order) else []:
            k = int(classes[rows[0]]) - 1
            n = int(self.members[k + 1])
            h_rows = all_h[rows]
            q = h_rows @ w["m"][k, :n].T
            q += w["mb"][k, :n]
            if not bounded:
                q -= q.max(axis=1, keepdims=True)
            np.exp(q, out=q)
            q /= q.sum(axis=1, keepdims=True)
            q[np.arange(len(rows)), self.member_of[all_y[rows]]] -= 1
            q *= scale
            g["m"][k, :n], g["mb"][k, :n] = q.T @ h_rows, q.sum(axis=0)
            dh_all[rows] += q @ w["m"][k, :n]
        back, da_all = np.zeros((lanes, HIDDEN), np.float32), []
        for t in reversed(range(steps)):
            before, z, r, n, un = held[t]
            dh = dh_all[t * lanes : (t + 1) * lanes] + back
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (before - n) * z * (1 - z)
            dr = dn * un * r * (1 - r)
            du = np.hstack([dz, dr, dn * r])
            g["u"] += before.T @ du
            da_all.append(np.hstack([dz, dr, dn]))
            back = (dh * z + du @ w["u"].T) * starts[t]
        ids = x.T[::-1].ravel()
        order = np.argsort(ids, kind="stable")
        begins = np.flatnonzero(np.r_[True, np.diff(ids[order]) != 0])
        g["in"][ids[order[begins]]] = np.add.reduceat(np.concatenate(da_all)[order], begins, axis=0)
        return h, g

    def score(self, texts: list[np.ndarray], rare_log: list[np.ndarray]) -> np.ndarray:
        """Natural log-likelihood of each text (input ids, the last one 0). rare_log: of each word, its log share of its
        class, 0 where the network itself gives it. Texts go side by side, the longest first, so that those still running
        are always the first ones."""
        sizes = np.array([len(t) for t in texts])
        order = np.argsort(-sizes, kind="stable")
        total = np.array([r.sum() for r in rare_log])
        flat = np.concatenate([texts[k] for k in order]).astype(np.int64)
        starts = np.cumsum(sizes[order]) - sizes[order]
        running = np.searchsorted(-sizes[order], -np.arange(1, sizes.max() + 1), side="right")
        h = np.zeros((len(texts), HIDDEN), np.float32)
        previous = np.zeros(len(texts), np.int64)
        got = np.zeros(len(texts))
        held, pending = [], 0

        def flush():
            states, ids, lanes = (np.concatenate(x) for x in zip(*held))
            np.add.at(got, lanes, self.member_log(states, ids))

        for t, many in enumerate(running.tolist()):
            h = self.step(h[:many], previous[:many])[0]
            ids = flat[starts[:many] + t]
            got[:many] += self.chosen_log(h, self.class_of[ids])
            lanes = np.flatnonzero(self.member_of[ids] >= 0)
            if len(lanes):
                held.append((h[lanes], ids[lanes], lanes))
                pending += len(lanes)
                if pending > 30_000:
                    flush()
                    held, pending = [], 0
            previous = ids
        if held:
            flush()
        total[order] += got
        return total


# ---- Spark -------------------------------------------------------------------------------------------------------------

_BLOCKS = "block long, ids binary, sizes binary, codes binary, words array<string>, counts array<long>, first int"


def _coded(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of the texts, and per text its size and its codes: places of its words, from 1, and 0 at its end."""
    cut = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words = cut.flatten().dictionary_encode()
    at, ends = words.indices.to_numpy(), cut.offsets.to_numpy()
    full = pc.greater(pc.binary_length(words.dictionary), 0)  # white space at the ends of a text gives empty words
    some = full.to_numpy(zero_copy_only=False)
    code = np.cumsum(some)[at]
    there = some[at]
    sizes = np.diff(np.r_[0, np.cumsum(there)][ends - ends[0]]) + 1
    codes = np.zeros(sizes.sum(), np.int32)
    inner = np.ones(len(codes), bool)
    inner[np.cumsum(sizes) - 1] = False
    codes[inner] = code[there]
    return words.dictionary.filter(full), sizes.astype(np.int64), codes


def _blocked(batches):
    """Rows of a block: one with its documents, coded, then its word list in parts. Code 0 is the end token."""
    task, number = TaskContext.get().partitionId(), 0
    types = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.int32()]
    names = [c.split()[0] for c in _BLOCKS.split(", ")]
    row = lambda *values: pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array([v], t) for v, t in zip(values, types)], names=names)
    listed = lambda values: pa.ListArray.from_arrays([0, len(values)], values)

    def flush():
        block = (task << 24) + number
        part = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        words, sizes, codes = _coded(part.column(2))
        ids = pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["id", "held"])
        yield row(block, _frame(ids), sizes.tobytes(), zlib.compress(codes.tobytes(), 1), None, None, 0)
        n = np.bincount(codes[np.repeat(~part.column(1).to_numpy(zero_copy_only=False), sizes)], minlength=len(words) + 1)
        words = pa.concat_arrays([pa.array([END]), words])
        for first in range(0, len(words), LIST):
            yield row(block, None, None, None, listed(words[first : first + LIST]), listed(pa.array(n[first : first + LIST])), first)

    parts, size = [], 0
    for batch in batches:
        for part in blocks(batch, "t"):
            parts.append(part)
            size += part.column(2).nbytes
            if size >= BLOCK:
                yield from flush()
                number, parts, size = number + 1, [], 0
    if parts:
        yield from flush()


def _frame(batch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _kinds(batches, model):
    network, speller = model.value
    for batch in batches:
        kinds = network.inputs(batch.column(0), speller)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(kinds, pa.int32())], names=["word", "c", "kind"])


def _read(batches):
    """Of each block of a task: the sizes and codes of its training texts, and its words. Columns ids, sizes, words, codes; the
    documents of a block come before its word list."""

    def told():
        held = pa.ipc.open_stream(block["ids"]).read_all()["held"].to_numpy()
        sizes, codes = np.frombuffer(block["sizes"], np.int64), np.frombuffer(zlib.decompress(block["codes"]), np.int32)
        return sizes[~held], codes[np.repeat(~held, sizes)], pa.concat_arrays(words)

    block, words = None, []
    for batch in batches:
        for row in range(batch.num_rows):
            listed = batch.column(2)[row]
            if listed.is_valid:
                words.append(listed.values)
                continue
            if block:
                yield told()
            block, words = {name: batch.column(k)[row].as_py() for k, name in ((0, "ids"), (1, "sizes"), (3, "codes"))}, []
    if block:
        yield told()


def _moments(batches, telling):
    """One row a task: its sum of ``_moment``, and its number of texts."""
    total, n = 0.0, 0
    for sizes, codes, words in _read(batches):
        total = total + _moment(sizes, codes, _places(words, telling), len(telling))
        n += len(sizes)
    if n:
        yield _weighted({"": total}, n)


def _spelled(batches, telling, centres):
    """Pieces of spelling of each block with their counts by group; the piece END has those of all words."""
    for sizes, codes, words in _read(batches):
        counts = _word_groups(sizes, codes, _places(words, telling), centres, len(words))
        there = counts.any(axis=1)
        pieces, n = _piece_counts(words.filter(pa.array(there)), counts[there])
        n = np.vstack([n, counts.sum(axis=0)]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.concat_arrays([pieces, pa.array([END])]), *map(pa.array, n.T)], names=["piece", *_GROUPS])


_GROUPS = [f"g{g}" for g in range(GROUPS)]


def learned(rows: DataFrame, telling: list[str]) -> Speller:
    """The classes by spelling, from all training texts. rows: ids, sizes, words, codes of blocks."""
    sums = rows.mapInArrow(lambda batches: _moments(batches, telling), "weights binary, n long").repartition(PARTS).mapInArrow(_summed, "weights binary, n long")
    moment = sum((np.frombuffer(row["weights"], np.float64) for row in sums.collect()), np.zeros((len(telling) + 1) ** 2))  # PARTS rows at most
    centres = _centres(moment.reshape(len(telling) + 1, -1))
    pieces = rows.mapInArrow(lambda batches: _spelled(batches, telling, centres), ", ".join(["piece string", *(f"{g} long" for g in _GROUPS)]))
    n = sum(F.col(g) for g in _GROUPS)
    counted = pieces.groupBy("piece").agg(*(F.sum(g).alias(g) for g in _GROUPS)).filter((n > 2) | (F.col("piece") == END))
    found = {row["piece"]: row[1:] for row in counted.orderBy(F.col("piece") != END, n.desc(), "piece").limit(PIECES + 1).collect()}
    total = np.array(found.pop(END, [0] * GROUPS), float)
    return Speller.of_counts(list(found), np.array(list(found.values()), float).reshape(-1, GROUPS), total)


def _first_trained(batches, model, last):
    """The first round, all of it in one task."""
    network, speller = model.value
    ids = [network.inputs(words, speller)[codes] for _, codes, words in _read(batches)]
    ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    if len(ids):
        network = replace(network, weights={k: v.copy() for k, v in network.weights.items()})
        network.train(ids, last)
        yield _weighted({k: v.astype(np.float64) for k, v in network.weights.items()}, 1)


def _trained(batches, model):
    """One row a task: its weights times the number of words that it trained on, and that number."""
    network, speller = model.value
    network = replace(network, weights={k: v.copy() for k, v in network.weights.items()})
    steps, seen = Steps(network.weights, FINE), 0
    for _, codes, words in _read(batches):
        if len(codes):
            network.over(network.inputs(words, speller)[codes], steps, WIDE)
            seen += len(codes)
    if seen:
        yield _weighted({k: v.astype(np.float64) * seen for k, v in network.weights.items()}, seen)


def _weighted(weights: dict[str, np.ndarray], n: int) -> pa.RecordBatch:
    flat = np.concatenate([weights[k].ravel() for k in sorted(weights)])
    return pa.RecordBatch.from_arrays([pa.array([flat.tobytes()], pa.binary()), pa.array([n], pa.int64())], names=["weights", "n"])


def _summed(batches):
    total, n = None, 0
    for batch in batches:
        for weights, some in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = np.frombuffer(weights, np.float64)
            total, n = own if total is None else total + own, n + some
    if n:
        yield _weighted({"": total}, n)


def rounds(sizes: list[int]) -> list[int]:
    """Round of each block, given their bytes in order: FIRST bytes or more in the first one, in each next one MORE times those
    of all before or more."""
    out, now, own, before = [], 0, 0, 0
    for n in sizes:
        if own >= (MORE * before if now else FIRST):
            now, before, own = now + 1, before + own, 0
        out.append(now)
        own += n
    return out


def trained(written: DataFrame, network: Network, speller: Speller) -> Network:
    """The network trained over all blocks, round by round (``rounds``), in the order of a hash of the blocks. What is collected
    is a row for each block, of BLOCK bytes of text, and PARTS sums of weights a round."""
    spark, schema = written.sparkSession, "weights binary, n long"
    listed = written.filter("ids IS NOT NULL").select("block", F.length("codes").alias("n")).orderBy(F.xxhash64("block"), "block").collect()
    dealt = rounds([row["n"] for row in listed])
    for now in sorted(set(dealt)):
        model = spark.sparkContext.broadcast((network, speller))
        rows = written.filter(F.col("block").isin([row["block"] for row, k in zip(listed, dealt) if k == now]))
        if now:
            rows = rows.select("ids", "sizes", "words", "codes").mapInArrow(lambda batches, model=model: _trained(batches, model), schema)
            sums = rows.repartition(PARTS).mapInArrow(_summed, schema).collect()  # PARTS rows at most
        else:
            rows = rows.repartition(1).sortWithinPartitions("block", F.col("ids").isNull(), "first").select("ids", "sizes", "words", "codes")
            sums = rows.mapInArrow(lambda batches, model=model: _first_trained(batches, model, dealt[-1] == 0), schema).collect()  # one row
        if sums:
            flat = sum(np.frombuffer(row["weights"], np.float64) for row in sums) / sum(row["n"] for row in sums)
            begin, weights = 0, {}
            for k in sorted(network.weights):
                shape, size = network.weights[k].shape, network.weights[k].size
                weights[k] = flat[begin : begin + size].reshape(shape).astype(np.float32)
                begin += size
            network = replace(network, weights=weights)
    network.settle()
    return network


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scored(block: pa.Table, listed: pa.Table, model, totals) -> pa.Table:
    """Scores of one block from its coded documents and the counts of its words."""
    network = model.value[0]
    n_train, distinct, class_count, class_words = totals.value
    at = listed["code"].to_numpy()
    c, kind = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    c[at], kind[at] = listed["c"].to_numpy(), listed["kind"].to_numpy()
    base = np.log10((c + 1) / (n_train + distinct + 1))
    rare = kind > len(network.frequent)
    share = np.zeros(len(c), np.float64)
    share[rare] = np.log((c[rare] + 1) / (class_count[kind[rare]] + class_words[kind[rare]] + 1))
    ids = pa.ipc.open_stream(block["ids"][0].as_py()).read_all()
    sizes = np.frombuffer(block["sizes"][0].as_py(), np.int64)
    codes = np.frombuffer(zlib.decompress(block["codes"][0].as_py()), np.int32)
    starts = np.cumsum(sizes) - sizes
    cuts = starts[1:]
    score = network.score(np.split(kind[codes], cuts), np.split(share[codes], cuts)) / np.log(10) if n_train else np.zeros(len(sizes))
    return pa.table({
        "doc_id": ids["id"], "held_out": ids["held"], "n_tokens": sizes, "n_known": np.add.reduceat((c[codes] > 0).astype(np.int64), starts),
        "train_tokens": np.full(len(sizes), n_train, np.int64), "base_score": np.add.reduceat(base[codes], starts), "score": score,
    }).cast(pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), *((k, pa.int64()) for k in ("n_tokens", "n_known", "train_tokens")), ("base_score", pa.float64()), ("score", pa.float64())]))


def fit(texts: list[str], frequent: list[str]) -> tuple[Network, Speller]:
    """The model of texts in memory, trained in one round."""
    words, sizes, codes = _coded(pa.array(texts, pa.string()))
    words, telling = pa.concat_arrays([pa.array([END]), words]), frequent[:TELLING]
    place = _places(words, telling)
    counts = _word_groups(sizes, codes, place, _centres(_moment(sizes, codes, place, len(telling))), len(words))
    pieces, n = _piece_counts(words.slice(1), counts[1:])
    speller = Speller.of_counts(pieces.to_pylist(), n, counts.sum(axis=0))
    network = Network.blank(frequent, speller)
    if texts:
        network.train(network.inputs(words, speller)[codes])
    return network, speller


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    read = docs.select(F.col(id_col).cast("long").alias("id"), (crc_mod(id_col, FOLDS) == HELD).alias("held"), text_of(text_col).alias("t"))
    written = checkpointed(read.mapInArrow(_blocked, _BLOCKS))
    lists = written.filter("words IS NOT NULL").select("block", "first", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w"))
    lists = lists.select("block", (F.col("first") + F.col("at")).alias("code"), F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    counts = checkpointed(lists.groupBy("word").agg(F.sum("n").alias("c")))
    whole = counts.filter("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    common = counts.filter((F.col("c") >= LEAST) & (F.col("word") != END)).orderBy(F.desc("c"), "word").limit(CLASSES * SIZE)
    frequent = [row["word"] for row in common.collect()]
    speller = learned(written.select("ids", "sizes", "words", "codes"), frequent[:TELLING])
    network = trained(written, Network.blank(frequent, speller), speller)
    model = spark.sparkContext.broadcast((network, speller))
    classed = checkpointed(counts.mapInArrow(lambda batches: _kinds(batches, model), "word string, c long, kind int"))
    n_kinds = len(network.class_of)
    class_count, class_words = np.zeros(n_kinds), np.zeros(n_kinds)
    for row in classed.filter("c > 0").groupBy("kind").agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect():  # n_kinds rows at most
        class_count[row["kind"]], class_words[row["kind"]] = row["c"], row["n"]
    totals = spark.sparkContext.broadcast((whole["n"], whole["v"], class_count, class_words))
    told = lists.select("block", "code", "word").join(classed, "word").select("block", "code", "c", "kind")
    coded = written.filter("words IS NULL").select(F.col("block").alias("coded"), "ids", "sizes", "codes")
    return coded.groupBy("coded").cogroup(told.groupBy("block")).applyInArrow(lambda a, b: _scored(a, b, model, totals), _SCORES)


def op5_lm_score(spark, sf_dir: str) -> DataFrame:
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
