"""Toxicity by compression distance between zstandard dictionaries.

Two dictionaries share an ordinary part, trained on windows of ordinary text; the toxic one adds a part trained apart, on
toxic text, where the ordinary one has filler that matches nothing. A window of WINDOW words that compresses shorter with
the toxic dictionary holds toxic matter; by how many bytes, is its excess. The toxic part is trained on those words of
toxic documents that hold character runs many times likelier there than in ordinary ones. Without that choice, and without
the shared part, what the two kinds of text have in common drowns the few words that tell them apart: dictionaries trained
on all windows of the two classes gave a held-out accuracy of 0.65, where this gives 0.995 (README). Thresholds on the excess are calibrated on a second half of the sample, as quantiles of
ordinary windows; the shares of windows over them, the largest excesses and the mean excess give the score, by a logistic
regression fitted on that half.

The model is fitted on a bounded sample of whole texts (``labelled.ROWS`` labelled rows of each class, ``labelled.CHARS``
characters of them in all); every text is scored whole, window by window. Scoring is one pass without a shuffle.

Defined results: null text counts as empty; an empty text is scored as one window without excess; a null id is kept (and
is never in the sample); repeated rows get equal scores; without labels of both classes the score is the share of toxic
ones, 0 if there are none; no rows in, no rows out; other columns are not looked at.
"""

from __future__ import annotations

from array import array
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fringelake.llm import labelled
from fringelake.llm.common import blocks, kept, table

FOLDS, HELD, THRESHOLD = 4, 2, 0.3
#: A row leaves the pipeline from this score on, the query's own threshold.
REJECT = THRESHOLD
WINDOW, ORDINARY_BYTES, TOXIC_BYTES, LEVEL = 6, 16384, 4096, 3
#: Bytes of a run, and of the longest beginning of a word; how many times likelier it must be in toxic text, and the least number of words that it follows there.
RUN, LONGEST, LIFT, LEAST = 5, 12, 60, 8
LEAD = 64
QUANTILES = (0.95, 0.99, 0.997, 0.999)


def windows(text: str, size: int = WINDOW) -> list[bytes]:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return [b" %b " % b" ".join(words[k : k + size]) for k in range(0, len(words), size)]


def runs(word: bytes) -> set[bytes]:
    """The runs of RUN bytes of a word between spaces, and its beginnings of up to LONGEST bytes."""
    return {word[k : k + RUN] for k in range(len(word) - RUN + 1)} | {word[:k] for k in range(RUN + 1, min(LONGEST, len(word)) + 1)}


def followed(texts: list[str]) -> tuple[list[bytes], np.ndarray]:
    """The distinct words in order, and for each distinct pair of neighbours, in order, the place of the second: what near
    copies share counts once."""
    known, codes = {}, array("q")
    for text in texts:
        codes.append(0)
        codes.extend(known.setdefault(w, len(known) + 1) for w in text.encode("utf-8", "surrogatepass").lower().split())
    words = sorted(known)
    place = np.zeros(len(words) + 1, np.int64)
    place[np.fromiter(map(known.__getitem__, words), np.int64, len(words))] = np.arange(1, len(words) + 1)
    code, size = place[np.frombuffer(codes, np.int64)], len(words) + 1
    return words, np.unique((code[:-1] * size + code[1:])[code[1:] > 0]) % size - 1


def toxic_words(toxic: list[str], ordinary: list[str]) -> list[bytes]:
    """Words of toxic texts that hold a run which tells them from ordinary texts, once for each word that they follow."""
    here, there = Counter(), Counter()
    words, pairs = followed(toxic)
    others, other_pairs = followed(ordinary)
    for its, seconds, counts in ((words, pairs, here), (others, other_pairs, there)):
        for word, n in zip(its, np.bincount(seconds, minlength=len(its)).tolist()):
            for run in runs(b" %b " % word):
                counts[run] += n
    share = len(pairs) / max(len(other_pairs), 1)
    telling = {r for r, n in here.items() if n >= LEAST and n >= LIFT * share * (there[r] + 1)}
    chosen = np.array([not telling.isdisjoint(runs(b" %b " % word)) for word in words], bool)
    return [b" %b " % words[k] for k in pairs[chosen[pairs]]] if len(pairs) else []


#: The three repeat offsets that end the header of every trained dictionary (a fixed value of the format).
_OFFSETS = b"\x01\x00\x00\x00\x04\x00\x00\x00\x08\x00\x00\x00"


def train(samples: list[bytes], size: int) -> bytes:
    """The content of a dictionary trained on the samples; too few samples are the content themselves."""
    import zstandard

    try:
        whole = zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[:size]
    return whole[whole.index(_OFFSETS) + len(_OFFSETS) :]


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    thresholds: np.ndarray
    mean: np.ndarray
    deviation: np.ndarray
    weights: np.ndarray
    constant: float | None = None

    def compressors(self):
        import zstandard

        parameters = zstandard.ZstdCompressionParameters.from_level(LEVEL)
        for content in (self.ordinary + bytes(len(self.toxic)), self.ordinary + self.toxic):
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(compression_params=parameters)
            yield zstandard.ZstdCompressor(compression_params=parameters, dict_data=dictionary)

    def excesses(self):
        """A function from a text to the bytes that each of its windows is shorter by with the toxic dictionary. A known lead
        stands before each window, so that no frame is too short to be compressed at all."""
        plain, toxic = (x.compress for x in self.compressors())
        lead = self.ordinary[:LEAD]
        return lambda text: np.array([len(plain(lead + w)) - len(toxic(lead + w)) for w in windows(text)] or [0])

    def scorer(self):
        """A function from texts to scores."""
        if self.constant is not None:
            return lambda texts: np.full(len(texts), self.constant)
        excesses = self.excesses()

        def score(texts):
            x = np.array([features(excesses(t), self.thresholds) for t in texts])
            z = (x.reshape(len(texts), len(self.mean)) - self.mean) / self.deviation
            return labelled.sigmoid(z @ self.weights[:-1] + self.weights[-1])

        return score


def features(excess: np.ndarray, thresholds: np.ndarray) -> list[float]:
    top = np.sort(excess)[::-1]
    over = [(excess > t).sum() for t in thresholds]
    return [top[0], top[:2].mean(), top[:4].mean(), excess.mean(), np.log(len(excess)), *np.log1p(over), *(n / len(excess) for n in over)]


def fit(texts: list[str], y: np.ndarray) -> Model:
    none = np.zeros(0)
    if y.sum() < 4 or (1 - y).sum() < 4:
        return Model(b"", b"", none, none, none, none, float(y.mean()) if len(y) else 0.0)
    first = np.zeros(len(y), bool)  # half of each class for the dictionaries, the other half for thresholds and weights
    for kind in (0, 1):
        first[np.flatnonzero(y == kind)[::2]] = True
    toxic = [t for t, k, f in zip(texts, y, first) if k and f]
    plain = [t for t, k, f in zip(texts, y, first) if not k and f]
    part = train([w for t in plain for w in windows(t)], ORDINARY_BYTES)
    model = Model(part, train(toxic_words(toxic, plain), TOXIC_BYTES), none, none, none, none)
    excesses = list(map(model.excesses(), texts))
    calm = np.concatenate([e for e, k, f in zip(excesses, y, first) if not k and not f])
    model.thresholds = np.unique(np.quantile(calm, QUANTILES))
    rest = np.flatnonzero(~first)
    x = np.array([features(excesses[k], model.thresholds) for k in rest])
    model.mean, model.deviation, model.weights = labelled.logistic(x, y[rest])
    return model


def fitted(spark, docs: DataFrame, sf_dir: str) -> Model:
    _, texts, y = labelled.sample(docs, table(spark, sf_dir, "labels"), "toxic", FOLDS, HELD)
    return fit(texts, y)


def _scorer(model):
    found = model.value
    return kept("toxicity", found, found.scorer)


def _scored(batches, model):
    score = _scorer(model)
    for batch in batches:
        for part in blocks(batch, "t"):
            found = score(part.column("t").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(found, pa.float64())], names=["doc_id", "score"])


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = spark.sparkContext.broadcast(fitted(spark, docs, sf_dir))
    return labelled.scored(docs, lambda batches: _scored(batches, model), FOLDS, HELD, THRESHOLD)


def drop_toxic(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of docs whose score is below REJECT, all columns; the model is fitted on the labelled rows among docs. Null and
    empty texts are scored as one empty window; rows with a null id are scored like any other; repeated rows stay or go
    together; no rows in, no rows out."""
    model = spark.sparkContext.broadcast(fitted(spark, docs, sf_dir))
    return labelled.kept_rows(docs, lambda texts: _scorer(model)(texts) < REJECT)
