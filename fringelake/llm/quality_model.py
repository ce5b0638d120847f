"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Random indexing: every word has a fixed sparse vector of +1 and -1 that a hash of the word chooses; the vector of a word is
the sum of the fixed vectors of the words around it in the sample, scaled to unit length. Words that are not in the sample
often enough are represented by their affixes (first two and last three characters, with the kind of their letters),
whose vectors are summed the same way. A document is the mean and the spread of its words' vectors, the likeness of
neighbouring words, and the shares of repeated and of unknown words. A two-layer numpy network reads that; its probabilities are calibrated
by one temperature, chosen on rows that it was not trained on.

The fit uses a bounded sample of whole texts (``labelled.ROWS`` labelled rows of each class, ``labelled.CHARS`` characters of
them in all); the model has vectors of its WORDS commonest words and as many affixes. Every text is scored whole. Scoring is one pass without a shuffle.

Defined results: null text counts as empty; an empty text is scored from zero vectors; a null id is kept (and is never in
the sample); repeated rows get equal scores; without labels of both classes the score is the share of good ones, 1 if
there are none; no rows in, no rows out; other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fringelake.llm import labelled
from fringelake.llm.common import blocks, kept, table

FOLDS, HELD, THRESHOLD = 5, 0, 0.3
#: A row leaves the pipeline below this score, the query's own threshold.
KEEP = THRESHOLD
SIZE, NONZERO, WINDOW, LEAST, WORDS = 48, 6, 2, 3, 20_000
HIDDEN, STEPS, RATE, DECAY = 24, 400, 0.02, 1e-4
#: Words of text that are pooled at once.
BLOCK = 1 << 19


def fixed_vectors(words: list[str]) -> np.ndarray:
    """The sparse random vector of each word, chosen by its hash."""
    from xxhash import xxh64_intdigest

    seeds = np.array([xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words], np.uint64)
    out = np.zeros((len(words), SIZE), np.float32)
    rows = np.arange(len(words))
    for k in range(NONZERO):
        draw = (seeds * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k * 0xBF58476D1CE4E5B9 % 2**64)) >> np.uint64(20)
        seeds = seeds ^ (draw * np.uint64(0x94D049BB133111EB))
        out[rows, (draw % np.uint64(SIZE)).astype(np.int64)] += np.where((draw >> np.uint64(20)) & np.uint64(1), 1, -1)
    return out


def affixes(word: str) -> tuple[str, str]:
    kind = "A" if word.isupper() else "a" if word.isalpha() else "0" if word.isdigit() else "."
    return f"^{word[:2]}{kind}", f"{word[-3:]}${kind}"


@dataclass
class Vectors:
    """Rows of `matrix` by word and by affix; the last row is zero."""

    words: dict = field(default_factory=dict)
    parts: dict = field(default_factory=dict)
    matrix: np.ndarray = field(default_factory=lambda: np.zeros((1, SIZE), np.float32))

    @staticmethod
    def learned(texts: list[str]) -> Vectors:
        counts = Counter()
        for text in texts:
            counts.update(text.split())
        words = {w: k for k, (w, n) in enumerate(counts.most_common(WORDS)) if n >= LEAST}
        pairs = Counter()
        for w, n in counts.items():
            for part in affixes(w):
                pairs[part] += n
        parts = {p: len(words) + k for k, (p, n) in enumerate(pairs.most_common(WORDS)) if n >= LEAST}
        sums = np.zeros((len(words) + len(parts) + 1, SIZE), np.float32)
        vocabulary = {w: k for k, w in enumerate(counts)}
        fixed = fixed_vectors(list(vocabulary))
        known = {w: [r for r in (words.get(w), *(parts.get(p) for p in affixes(w))) if r is not None] for w in words}
        for text in texts:
            ws = text.split()
            if not ws:
                continue
            rows = [known.get(w) or [parts[p] for p in affixes(w) if p in parts] for w in ws]
            own = np.pad(fixed[[vocabulary[w] for w in ws]], ((WINDOW, WINDOW), (0, 0)))
            around = sum(own[k : k + len(ws)] for k in range(2 * WINDOW + 1) if k != WINDOW)
            owner = [r for some in rows for r in some]
            np.add.at(sums, owner, around[np.repeat(np.arange(len(ws)), list(map(len, rows)))])
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        return Vectors(words, parts, (sums / np.maximum(norms, 1e-9)).astype(np.float32))

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The vector of each word, and whether the word itself is known."""
        none = len(self.matrix) - 1
        own = np.fromiter((self.words.get(w, none) for w in words), np.int64, len(words))
        out = self.matrix[own]
        strange = np.flatnonzero(own == none)
        if len(strange):
            pairs = [affixes(words[k]) for k in strange]
            ids = np.array([[self.parts.get(a, none), self.parts.get(b, none)] for a, b in pairs])
            out[strange] = self.matrix[ids].mean(axis=1)
        return out, own != none


def pooled(texts: list[str], vectors: Vectors) -> np.ndarray:
    """One row per text: mean, spread, likeness of neighbours, share of repeated neighbours and of unknown words."""
    known: dict[str, int] = {}
    codes, sizes = [], np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        words = text.split()
        sizes[k] = len(words)
        codes += [known.setdefault(w, len(known)) for w in words]
    out = np.zeros((len(texts), 2 * SIZE + 3))
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    table_, familiar = vectors.of(list(known))
    code = np.array(codes)
    x = table_[code]
    n = sizes[full][:, None]
    begins = np.cumsum(sizes[full]) - sizes[full]
    mean = np.add.reduceat(x, begins, axis=0) / n
    spread = np.sqrt(np.maximum(np.add.reduceat(x * x, begins, axis=0) / n - mean**2, 0))
    alike = np.zeros(len(x), np.float32)
    alike[1:] = np.einsum("ij,ij->i", x[1:], x[:-1])
    same = np.zeros(len(x), np.float32)
    same[1:] = code[1:] == code[:-1]
    alike[begins] = same[begins] = 0
    extra = [np.add.reduceat(v, begins)[:, None] / n for v in (alike, same, (~familiar[code]).astype(np.float32))]
    out[full] = np.hstack([mean, spread, *extra])
    return out


@dataclass
class Model:
    vectors: Vectors
    mean: np.ndarray | None = None
    deviation: np.ndarray | None = None
    layers: list | None = None
    temperature: float = 1.0
    constant: float | None = None

    def logits(self, texts: list[str]) -> np.ndarray:
        return _forward((pooled(texts, self.vectors) - self.mean) / self.deviation, self.layers)[1]

    def score(self, texts: list[str]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return labelled.sigmoid(self.logits(texts) / self.temperature)


def _forward(x, layers):
    w1, b1, w2, b2 = layers
    hidden = np.tanh(x @ w1 + b1)
    return hidden, hidden @ w2 + b2


def slopes(x: np.ndarray, y: np.ndarray, share: np.ndarray, layers: list) -> list:
    """Gradient of the weighted log loss with decay, by layer."""
    hidden, out = _forward(x, layers)
    error = (labelled.sigmoid(out) - y) * share
    back = np.outer(error, layers[2]) * (1 - hidden**2)
    return [x.T @ back + DECAY * layers[0], back.sum(axis=0), hidden.T @ error + DECAY * layers[2], error.sum()]


def network(x: np.ndarray, y: np.ndarray, seed: int = 7) -> list:
    """Weights of a tanh layer and a logistic output, by Adam on all rows; both classes weigh the same."""
    draw = np.random.default_rng(seed)
    layers = [draw.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), draw.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(())]
    first, second = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers]
    share = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    for step in range(1, STEPS + 1):
        for k, g in enumerate(slopes(x, y, share, layers)):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            layers[k] = layers[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return layers


def fit(texts: list[str], y: np.ndarray) -> Model:
    if y.sum() < 4 or (1 - y).sum() < 4:
        return Model(Vectors(), constant=float(y.mean()) if len(y) else 1.0)
    vectors = Vectors.learned(texts)
    x = np.vstack([pooled(texts[k : k + 100], vectors) for k in range(0, len(texts), 100)])
    model = Model(vectors, x.mean(axis=0), x.std(axis=0) + 1e-3)
    z = (x - model.mean) / model.deviation
    calibration = np.zeros(len(y), bool)
    for kind in (0, 1):
        calibration[np.flatnonzero(y == kind)[::4]] = True
    model.layers = network(z[~calibration], y[~calibration])
    out = _forward(z[calibration], model.layers)[1]
    held = y[calibration]

    def loss(temperature):
        return np.mean(np.logaddexp(0, np.where(held == 1, -1, 1) * out / temperature))

    model.temperature = min(np.geomspace(0.25, 16, 61), key=loss)
    return model


def fitted(spark, docs: DataFrame, sf_dir: str) -> Model:
    _, texts, y = labelled.sample(docs, table(spark, sf_dir, "labels"), "quality", FOLDS, HELD)
    return fit(texts, y)


def _model(model) -> Model:
    found = model.value
    return kept("quality", found, lambda: found)


def _scored(batches, model):
    for batch in batches:
        for part in blocks(batch, "t", BLOCK):
            found = _model(model).score(part.column("t").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(found, pa.float64())], names=["doc_id", "score"])


def op7_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = spark.sparkContext.broadcast(fitted(spark, docs, sf_dir))
    return labelled.scored(docs, lambda batches: _scored(batches, model), FOLDS, HELD, THRESHOLD)


def drop_poor(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of docs whose score is KEEP or more, all columns; the model is fitted on the labelled rows among docs. Null and
    empty texts are scored from zero vectors; rows with a null id are scored like any other; repeated rows stay or go together;
    no rows in, no rows out."""
    model = spark.sparkContext.broadcast(fitted(spark, docs, sf_dir))
    return labelled.kept_rows(docs, lambda texts: _model(model).score(texts) >= KEEP, limit=BLOCK)
