"""Document quality by Bradley-Terry pairwise ranking.

A document's strength is a weighted sum of text features. In a preference pair, the chance that the good
document beats the bad one is the logistic function of the difference of strengths, so the weights come
from logistic loss on feature differences. A document passes if its strength is above the quantile of
training strengths that equals the share of bad labels; scores are strengths scaled around that cut.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.text import Reader, Words, shingles
from larder.llm.stages import stored
from larder.llm.training import sigmoid

PASS = 0.3
BINS = 10
FEATURES = 20
#: Texts are taken in slices of about so many bytes, each with some fifty bytes of arrays a byte.
FEATURE_BYTES = 1 << 18


def _classes() -> np.ndarray:
    """A class for each byte: lower, upper, digit, blank, line end, symbol, stop, other ASCII, beyond ASCII."""
    kind = np.full(256, 7)
    for chars, k in (("abcdefghijklmnopqrstuvwxyz", 0), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), ("0123456789", 2), (" \t", 3),
                     ("\n\r", 4), ("#*$%&|<>", 5), (".,;:!?", 6)):
        kind[[ord(c) for c in chars]] = k
    kind[128:] = 8
    return kind


def features(words: Words, kind: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of features for each text; all are 0 for a text without words."""
    n = len(words.first) - 1
    row_of_byte = np.repeat(np.arange(n), np.diff(offsets))
    shares = np.bincount(row_of_byte * 9 + kind[words.data], minlength=9 * n).reshape(n, 9)
    size = np.maximum(shares.sum(axis=1), 1)
    counts = words.counts
    some = np.maximum(counts, 1)
    row = words.row
    lengths = (words.end - words.start).astype(float)
    total = np.bincount(row, lengths, n)
    spread = np.bincount(row, lengths**2, n) / some - (total / some) ** 2
    distinct, again, windows = np.zeros(n), np.zeros(n), np.zeros(n)
    triples, at = shingles(words, 3)
    for r in range(n):
        own = words.hash[words.first[r] : words.first[r + 1]]
        distinct[r] = len(np.unique(own))
        again[r] = np.count_nonzero(own[1:] == own[:-1])
        windows[r] = len(np.unique(triples[at[r] : at[r + 1]]))
    first_byte = kind[words.data[words.start]] if len(row) else row
    last_byte = kind[words.data[words.end - 1]] if len(row) else row
    by = lambda flags: np.bincount(row, flags, n) / some
    expected = distinct / np.maximum(np.power(some, 0.85), 1)
    columns = [
        *(shares[:, :9] / size[:, None]).T,
        np.log1p(counts),
        total / some,
        np.sqrt(np.maximum(spread, 0)),
        expected,
        distinct / some,
        again / some,
        1 - windows / np.maximum(np.diff(at), 1),
        by(first_byte == 1),
        by(last_byte == 5),
        by(last_byte == 6),
        by((first_byte == 1) & (lengths > 1) & (last_byte != 0)),
    ]
    return np.where(counts[:, None] > 0, np.stack(columns, axis=1), 0.0)


def _feature_batches(reader: Reader, column):
    """Rows and their features, slice by slice."""
    kind = _classes()
    for words in reader.slices(column, FEATURE_BYTES):
        text = column.slice(words.rows.start, words.rows.stop - words.rows.start)
        sizes = np.array([0 if x is None else x for x in pa.compute.binary_length(text).to_pylist()], np.int64)
        yield words.rows, features(words, kind, np.concatenate([[0], np.cumsum(sizes)]))


def _extract(batches):
    reader = Reader(lower=False)
    for batch in batches:
        rows = [r for _, x in _feature_batches(reader, batch.column(1)) for r in x]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=[batch.schema.names[0], "x"])


@dataclass
class Ranking:
    """Bin edges of each feature, a weight for each bin, the cut and the scale of scores."""

    edges: np.ndarray
    weights: np.ndarray
    cut: float
    scale: float

    def strengths(self, x: np.ndarray) -> np.ndarray:
        return one_hot(x, self.edges) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.scale * (self.strengths(x) - self.cut) + np.log(PASS / (1 - PASS)))


def one_hot(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    bins = edges.shape[1] + 1
    out = np.zeros((len(x), edges.shape[0] * bins))
    for j, cuts in enumerate(edges):
        out[np.arange(len(x)), j * bins + np.searchsorted(cuts, x[:, j], "right")] = 1
    return out


def learn(docs: DataFrame, labels: DataFrame, train: Column) -> Ranking:
    """The ranking from all labelled training rows, fitted in Spark.

    Bin edges are quantile sketches over all rows. Every good row is paired with a bad one and every bad
    row with a good one, by their places among their kind; the weights are Newton steps whose sums come from
    all pairs. The cut is the strength below which exactly the share of bad labels lies, the scale a
    logistic fit over all rows. Rows without id or with a label other than 0 and 1 are not used.
    """
    spark = docs.sparkSession
    known = labels.select("doc_id", F.col("quality").cast("int").alias("label")).filter(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & train
    ).dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("_id"), "label")
    # features are taken beside the texts, so that the join moves twenty numbers a row and no text
    features = docs.select(F.col("doc_id").cast("long"), "text").filter(train).mapInArrow(_extract, "doc_id long, x array<double>")
    rows = stored(features.join(known, F.col("doc_id") == F.col("_id")).select("label", "x"))
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    good, bad = counts.get(1, 0), counts.get(0, 0)
    edges = np.zeros((FEATURES, BINS - 1))
    if good + bad:
        probabilities = [i / BINS for i in range(1, BINS)]
        got = rows.select(*[F.percentile_approx(F.col("x")[j], probabilities, 100000) for j in range(FEATURES)]).first()
        edges = np.array([list(v) for v in got], float)
    if not good or not bad:  # nothing to rank: all pass, or all fail if only bad ones are known
        return Ranking(edges, np.zeros(edges.shape[0] * BINS), 1.0 if bad else -1.0, 1.0)
    weights = _pair_weights(spark, _pairs(spark, rows, good, bad), edges)
    strengths = stored(rows.mapInArrow(_strengths(edges, weights), "s double, label int"))
    cut = float(strengths.select("s").rdd.map(lambda r: r[0]).sortBy(lambda v: v).zipWithIndex()
                .filter(lambda t: t[1] == bad - 1).first()[0])
    return Ranking(edges, weights, cut, float(max(_scale(strengths, cut), 1e-3)))


def _pairs(spark, rows: DataFrame, good: int, bad: int) -> DataFrame:
    """(g, b) features of good and bad rows: the i-th of each kind meets the (i mod size)-th of the other."""

    def indexed(label: int) -> DataFrame:
        places = rows.filter(F.col("label") == label).select("x").rdd.zipWithIndex().map(lambda t: (t[1], t[0][0]))
        return stored(spark.createDataFrame(places, "i long, x array<double>"))

    goods, bads = indexed(1), indexed(0)
    by_good = goods.select(F.col("x").alias("g"), (F.col("i") % bad).alias("k")).join(
        bads.select(F.col("i").alias("k"), F.col("x").alias("b")), "k"
    )
    by_bad = bads.select(F.col("x").alias("b"), (F.col("i") % good).alias("k")).join(
        goods.select(F.col("i").alias("k"), F.col("x").alias("g")), "k"
    )
    return stored(by_good.select("g", "b").unionByName(by_bad.select("g", "b")))


def _pair_sums(edges: np.ndarray, w: np.ndarray):
    """Gradient and Hessian of the log-likelihood that the good row of each pair is the stronger, per task."""

    def sums(batches):
        size = len(w)
        gradient, hessian = np.zeros(size), np.zeros((size, size))
        for batch in batches:
            if not batch.num_rows:
                continue
            g = np.array(batch.column(0).to_pylist(), float).reshape(batch.num_rows, FEATURES)
            b = np.array(batch.column(1).to_pylist(), float).reshape(batch.num_rows, FEATURES)
            d = one_hot(g, edges) - one_hot(b, edges)
            p = sigmoid(d @ w)
            gradient += d.T @ (1 - p)
            hessian += (d * (p * (1 - p))[:, None]).T @ d
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([gradient, hessian.ravel()]).tobytes()])], names=["sums"])

    return sums


def _pair_weights(spark, pairs: DataFrame, edges: np.ndarray, ridge: float = 3.0, rounds: int = 30) -> np.ndarray:
    """Ridge logistic regression on all pair differences by Newton's method, as ``logistic`` does on few."""
    size = edges.shape[0] * (edges.shape[1] + 1)
    w = np.zeros(size)
    for _ in range(rounds):
        parts = pairs.mapInArrow(_pair_sums(edges, w.copy()), "sums binary").toArrow()["sums"].to_pylist()
        total = np.sum([np.frombuffer(x, np.float64) for x in parts], axis=0)
        gradient, hessian = total[:size] - ridge * w, total[size:].reshape(size, size) + ridge * np.eye(size)
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _strengths(edges: np.ndarray, weights: np.ndarray):
    def strengths(batches):
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), float).reshape(batch.num_rows, FEATURES)
            yield pa.RecordBatch.from_arrays([pa.array(one_hot(x, edges) @ weights, pa.float64()), batch.column(0)], names=["s", "label"])

    return strengths


def _scale(strengths: DataFrame, cut: float, ridge: float = 1e-3, rounds: int = 30) -> float:
    """Slope of a ridge logistic regression of the label on strength minus the cut, with an intercept."""
    a, b = 0.0, 0.0
    t = F.col("s") - F.lit(cut)
    y = F.col("label").cast("double")
    for _ in range(rounds):
        p = 1 / (1 + F.exp(-F.greatest(F.least(F.lit(a) * t + F.lit(b), F.lit(30.0)), F.lit(-30.0))))
        v = p * (1 - p)
        r = strengths.agg(F.sum((y - p) * t), F.sum(y - p), F.sum(v * t * t), F.sum(v * t), F.sum(v)).first()
        gradient = np.array([r[0] - ridge * a, r[1] - ridge * b])
        hessian = np.array([[r[2] + ridge, r[3]], [r[3], r[4] + ridge]])
        step = np.linalg.solve(hessian, gradient)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-6:
            break
    return a


def _scorer(model: Ranking, keep: int, text: int):
    def score(batches):
        reader = Reader(lower=False)
        for batch in batches:
            names = [f"c{i}" for i in range(keep)]
            for rows, x in _feature_batches(reader, batch.column(text)):  # small batches back: they are held on both sides
                kept = [c.slice(rows.start, rows.stop - rows.start) for c in batch.columns[:keep]]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(model.scores(x), pa.float64())], names=[*names, "score"])

    return score


def score_quality(docs: DataFrame, model: Ranking, keep: tuple[str, ...] = ("doc_id",), text_column: str = "text") -> DataFrame:
    """The ``keep`` columns of every row and its ``score``, 0 to 1; at 0.3 or more a document passes.

    Null texts count as empty; empty texts and texts without words get the score of all-zero features.
    Equal texts get equal scores; repeated rows are scored each. An empty table gives an empty one. Without
    labels of both kinds every row passes, or fails if only bad ones are known.
    """
    sent = keep if text_column in keep else (*keep, text_column)  # a kept text is sent once
    chosen = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(sent)])
    kinds = ", ".join(f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    scored = chosen.mapInArrow(_scorer(model, len(keep), sent.index(text_column)), f"{kinds}, score double")
    return scored.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], "score")
