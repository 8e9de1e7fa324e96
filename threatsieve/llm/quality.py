"""A quality classifier: a generalised additive model with pairwise interactions (cyclic boosting).

Each round visits every feature in turn and fits a shallow tree (a few cuts over the feature's bins) to
the current residuals; the sum of a feature's trees is a lookup table. The strongest pairs of features
then get tables of their own, boosted in the same way. A text's score is the sum of the tables' entries
at its bins, turned into a probability.

The model is fitted on at most ``max_labelled`` labelled rows (the smallest by a hash of the id); cuts
come from the same rows. Features are computed from the whole text. Labels, language, source and ids
are no inputs of a score.

Defined results: a null or empty text has the features of an empty text and gets a score; a null
``doc_id`` counts as not held out and is never trained on; repeated rows are scored alike; repeated or
null labels: an id's label is the largest non-null one; without any label, or with one class only, the
scores are that class's share (0.5 without any); empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threatsieve.llm.shared import batch_of, texts_of

MAX_LABELLED = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 80
RATE = 0.15
CUTS = 3
FOLDS = 5
THRESHOLD = 0.3

FEATURES = (
    "log_bytes", "log_words", "mean_word", "upper_share", "digit_share", "mark_share", "odd_mark_share",
    "marked_words", "pipe_share", "shouted_words", "distinct_words", "same_as_before", "longest_repeat", "distinct_lines",
    "top_word", "line_words", "stopped_words", "distinct_triples", "high_share", "alone_marks",
)
_PLAIN = np.zeros(256, bool)
_PLAIN[list(b".,;:!?'\"()- \n\t\r")] = True
_MARKS = np.zeros(256, bool)
_MARKS[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def features(text: bytes) -> list[float]:
    """The model's inputs, one number per name in ``FEATURES``."""
    size = len(text)
    bytes_seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words = text.split()
    n = len(words)
    w, s = max(n, 1), max(size, 1)
    marks = int(bytes_seen[_MARKS].sum())
    odd = int(bytes_seen[_MARKS & ~_PLAIN].sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    distinct = set(words)
    repeats = longest = run = shouted = marked = stopped = alone = 0
    before = None
    for word in words:
        if word == before:
            repeats += 1
            run += 1
            longest = max(longest, run)
        else:
            run, before = 0, word
        end = word[-1]
        if end < 127 and not 47 < end < 58 and not 64 < end < 91 and not 96 < end < 123:
            if end in b".!?":
                stopped += 1
            if len(word) == 1:
                alone += 1
            if end not in b".,;:?)'\"":
                marked += 1
        if len(word) > 1 and word.isupper():
            shouted += 1
    top = 0.0
    if n:
        counts: dict[bytes, int] = {}
        for word in words:
            counts[word] = counts.get(word, 0) + 1
        top = max(counts.values()) / n
    triples = len(set(zip(words, words[1:], words[2:], strict=False))) / max(n - 2, 1)
    return [
        np.log1p(size), np.log1p(n), size / w, bytes_seen[65:91].sum() / s, bytes_seen[48:58].sum() / s, marks / s, odd / s,
        marked / w, int(bytes_seen[124]) / w, shouted / w, len(distinct) / w, repeats / w, np.log1p(longest), len(set(lines)) / max(len(lines), 1),
        top, np.log1p(n / max(len(lines), 1)), stopped / w, triples, bytes_seen[128:].sum() / s, alone / w,
    ]


def feature_matrix(texts: Iterable[bytes]) -> np.ndarray:
    rows = [features(t) for t in texts]
    return np.array(rows, np.float64).reshape(len(rows), len(FEATURES))


@dataclass
class Model:
    """Lookup tables: one per feature over its bins, one per chosen pair over coarser bins."""

    cuts: list[np.ndarray]
    coarse: list[np.ndarray]
    base: float
    tables: np.ndarray
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def margins(self, values: np.ndarray) -> np.ndarray:
        total = np.full(len(values), self.base)
        for f, cuts in enumerate(self.cuts):
            total += self.tables[f][np.searchsorted(cuts, values[:, f], side="right")]
        for (f, g), table in zip(self.pairs, self.pair_tables, strict=True):
            row = np.searchsorted(self.coarse[f], values[:, f], side="right")
            total += table[row, np.searchsorted(self.coarse[g], values[:, g], side="right")]
        return total

    def scores(self, values: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margins(values), -30, 30)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _tree(gradient: np.ndarray, weight: np.ndarray, leaves: int) -> np.ndarray:
    """A shallow tree over ordered bins: the value of each bin's leaf. Greedy splits by squared gain."""
    spans = [(0, len(gradient))]
    g, h = np.concatenate([[0], gradient.cumsum()]), np.concatenate([[0], weight.cumsum()])

    def worth(a, b):
        return (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1.0)

    for _ in range(leaves):
        best = (1e-9, None, None)
        for k, (a, b) in enumerate(spans):
            if b - a > 1:
                at = np.arange(a + 1, b)
                gain = worth(a, at) + worth(at, b) - worth(a, b)
                best = max(best, (float(gain.max()), k, int(at[gain.argmax()])), key=lambda x: x[0])
        if best[1] is None:
            break
        a, b = spans[best[1]]
        spans[best[1] : best[1] + 1] = [(a, best[2]), (best[2], b)]
    out = np.zeros(len(gradient))
    for a, b in spans:
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + 1.0)
    return out


def _grid(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A tree over two features: the best cut of the first, then of the second on either side."""
    best, out = -1.0, np.zeros_like(gradient)
    for at in range(1, gradient.shape[0]):
        value, gain = np.zeros_like(gradient), 0.0
        for part in (slice(0, at), slice(at, None)):
            g, h = gradient[part].sum(axis=0), weight[part].sum(axis=0)
            value[part] = leaf = _tree(g, h, 1)
            gain += float((leaf * g).sum())
        if gain > best:
            best, out = gain, value
    return out


def fit(values: np.ndarray, labels: np.ndarray) -> Model:
    """Fits the tables; ``labels`` are 0 or 1."""
    share = (labels.sum() + 0.5) / (len(labels) + 1.0) if len(labels) else 0.5
    width = values.shape[1]
    if len(set(labels.tolist())) < 2:
        none = [np.empty(0)] * width
        return Model(none, none, float(np.log(share / (1 - share))), np.zeros((width, 1)), [], [])
    cuts, coarse = [_cuts(values[:, f], BINS) for f in range(width)], [_cuts(values[:, f], PAIR_BINS) for f in range(width)]
    bins = [np.searchsorted(cuts[f], values[:, f], side="right") for f in range(width)]
    tables = np.zeros((width, BINS + 1))
    base = float(np.log(share / (1 - share)))
    margin = np.full(len(labels), base)

    def gradients() -> tuple[np.ndarray, np.ndarray]:
        p = 1.0 / (1.0 + np.exp(-margin))
        return labels - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f in range(width):
            residual, weight = gradients()
            step = _tree(np.bincount(bins[f], residual, BINS + 1), np.bincount(bins[f], weight, BINS + 1), CUTS)
            tables[f] += RATE * step
            margin += RATE * step[bins[f]]
    rough = [np.searchsorted(coarse[f], values[:, f], side="right") for f in range(width)]
    side = PAIR_BINS + 1

    def grid_of(f: int, g: int) -> tuple[np.ndarray, np.ndarray]:
        residual, weight = gradients()
        cell = rough[f] * side + rough[g]
        return (np.bincount(cell, x, side * side).reshape(side, side) for x in (residual, weight))

    gains = []
    for f in range(width):
        for g in range(f + 1, width):
            residual, weight = grid_of(f, g)
            gains.append((-float((_grid(residual, weight) * residual).sum()), f, g))
    pairs = [(f, g) for _, f, g in sorted(gains)[:PAIRS]]
    pair_tables = [np.zeros((side, side)) for _ in pairs]
    for _ in range(ROUNDS // 2):
        for (f, g), table in zip(pairs, pair_tables, strict=True):
            step = _grid(*grid_of(f, g))
            table += RATE * step
            margin += RATE * step[rough[f], rough[g]]
    return Model(cuts, coarse, base, tables, pairs, pair_tables)


def held_out(doc_id: Column) -> Column:
    """True for the fold that is never trained on."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def fit_on(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """Fits on the whole texts of at most ``max_labelled`` labelled documents outside the held-out fold."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)  # at most that many small rows
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # An id that is repeated gives its least text, so the bound holds for rows as well and the fit is the same in every run.
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.min("text").alias("text"))
    rows = rows.select("quality", "text")
    schema = pa.schema([("quality", pa.int32()), ("values", pa.list_(pa.float64()))])

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch_of(schema, quality=batch["quality"], values=list(feature_matrix(texts_of(batch["text"]))))

    found = rows.mapInArrow(measure, "quality int, values array<double>").toArrow()
    values = np.array(found["values"].to_pylist(), np.float64).reshape(found.num_rows, len(FEATURES))
    order = np.lexsort([*values.T, found["quality"].to_numpy()])
    return fit(values[order], found["quality"].to_numpy()[order])


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row; the model is a few thousand numbers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.scores(feature_matrix(texts_of(batch["text"])))
            yield pa.record_batch([batch["doc_id"], pa.array(score, pa.float64())], ["doc_id", "score"])

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return columns.mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``threshold``, with all their columns."""
    place = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.scores(feature_matrix(texts_of(batch.column(place))))
            yield batch.filter(pa.array(score >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op10_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = scored(docs, model)
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)
