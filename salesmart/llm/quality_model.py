"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

A text is described by a few statistics. Random Fourier features of the standardised statistics
approximate a Gaussian kernel; the ridge scores come from normal equations that each partition
sums by itself. The scores' histogram, with the share of good documents per bin, is made
monotone by pooling adjacent violators, which gives the calibrated score.

All labelled rows take part in training. The matrices have a fixed size; ``SUMMING_TASKS`` of
them reach the driver, whatever the number of rows.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import documents, id_remainder, read_table
from salesmart.staging import stage

FOURIER = 256
GAMMA = 0.05
RIDGE = 1e-3
BINS = 400
#: Raw scores are near 0 and 1, the values they are fitted to; bins cover this range and clip.
RANGE = (-0.5, 1.5)
SUMMING_TASKS = 8
FOLDS = 3
HELD_OUT = 1

# ---- Fixed values: byte classes counted as statistics ----
CLASSES = {
    "capitals": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "small": b"abcdefghijklmnopqrstuvwxyz",
    "digits": b"0123456789",
    "marks": b".,;:!?'\"()-",
    "symbols": b"#*$%&|<>@^~_=+/\\{}[]",
}


def byte_classes() -> np.ndarray:
    table = np.zeros((len(CLASSES), 256))
    for k, members in enumerate(CLASSES.values()):
        table[k, list(members)] = 1
    return table


def statistics(text: str | None, classes: np.ndarray) -> list[float]:
    """What the classifier sees of a text; an empty text has values like any other."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()  # on the white space of the word pattern
    n = max(1, len(words))
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    chars = max(1, sum(map(len, words)))
    lines = [line for line in data.split(b"\n") if line.strip()]
    most = Counter(words)
    return [
        np.log1p(len(words)), chars / n, len(most) / n, max(most.values(), default=0) / n,
        sum(map(operator.eq, words, words[1:])) / n,
        len(set(lines)) / max(1, len(lines)), np.log1p(n / max(1, len(lines))),
        *(classes @ counts / chars), counts[128:].sum() / chars,
        np.log1p(max(map(len, words), default=0)),
    ]


STATISTICS = 7 + len(CLASSES) + 2


def statistics_of(text: Column) -> Column:
    classes = byte_classes()

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t, classes) for t in texts])

    return F.pandas_udf(run, "array<double>")(text)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    edges: np.ndarray
    values: np.ndarray

    def raw(self, values: np.ndarray) -> np.ndarray:
        return features(values, self.mean, self.scale) @ self.weights

    def score(self, values: np.ndarray) -> np.ndarray:
        """Calibrated scores from 0 to 1; 0.5 where nothing was learned."""
        return np.interp(self.raw(values), self.edges, self.values)


def features(values: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """A constant and the Fourier features of statistics, one row for each text."""
    random = np.random.default_rng(9)
    frequency = random.normal(0, np.sqrt(2 * GAMMA), (STATISTICS, FOURIER))
    shift = random.uniform(0, 2 * np.pi, FOURIER)
    waves = np.sqrt(2 / FOURIER) * np.cos((values - mean) / scale @ frequency + shift)
    return np.hstack([np.ones((len(values), 1)), waves])


def matrix(batch: pa.RecordBatch, column: str = "statistics") -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, STATISTICS)


def equations(labelled: DataFrame, mean: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of x xT and x y over all labelled rows."""
    size = FOURIER + 1

    def row(sums: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], names=["sums"])

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((size, size + 1))
        for batch in batches:
            for k in range(0, batch.num_rows, 2000):
                part = batch.slice(k, 2000)
                x, y = features(matrix(part), mean, scale), part.column("quality").to_numpy(zero_copy_only=False)
                sums += x.T @ np.column_stack([x, y])
        yield row(sums)

    def total(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((size, size + 1))
        for batch in batches:
            for part in batch.column("sums"):
                sums += np.frombuffer(part.as_py()).reshape(size, size + 1)
        yield row(sums)

    rows = labelled.select("statistics", "quality").mapInArrow(partial, "sums binary") \
        .repartition(SUMMING_TASKS).mapInArrow(total, "sums binary").collect()
    sums = sum(np.frombuffer(bytes(r["sums"])).reshape(size, size + 1) for r in rows)
    return sums[:, :size], sums[:, size]


def pooled(shares: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The non-decreasing values nearest to ``shares``: adjacent violators are pooled."""
    blocks: list[list[float]] = []
    for share, weight in zip(shares, weights, strict=True):
        blocks.append([share, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            value, heavy, n = blocks.pop()
            last = blocks[-1]
            last[0] = (last[0] * last[1] + value * heavy) / (last[1] + heavy)
            last[1], last[2] = last[1] + heavy, last[2] + n
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def train(labelled: DataFrame) -> Model:
    """Fit on rows with ``statistics`` and ``quality`` (0 or 1); 0.5 for all without rows."""
    summary = labelled.agg(
        F.count("*").alias("n"),
        F.array(*[F.avg(F.get("statistics", F.lit(k))) for k in range(STATISTICS)]).alias("mean"),
        F.array(*[F.stddev_pop(F.get("statistics", F.lit(k))) for k in range(STATISTICS)]).alias("scale"),
    ).first()
    if not summary["n"]:
        nothing = np.zeros(STATISTICS)
        return Model(nothing, nothing + 1, np.zeros(FOURIER + 1), np.array([0.0, 1.0]), np.array([0.5, 0.5]))
    mean, scale = np.array(summary["mean"]), np.array(summary["scale"])
    scale = np.where(scale > 1e-9, scale, 1.0)
    left, right = equations(labelled, mean, scale)
    weights = np.linalg.solve(left + RIDGE * summary["n"] / FOURIER * np.eye(FOURIER + 1), right)

    low, high = RANGE

    def binned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = features(matrix(batch), mean, scale) @ weights
            place = np.clip((raw - low) / (high - low) * BINS, 0, BINS - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(place), batch.column("quality")], names=["bin", "quality"])

    bins = labelled.select("statistics", "quality").mapInArrow(binned, "bin long, quality double") \
        .groupBy("bin").agg(F.count("*").alias("n"), F.avg("quality").alias("share")).collect()
    bins.sort(key=lambda r: r["bin"])
    values = pooled(np.array([r["share"] for r in bins]), np.array([r["n"] for r in bins], float))
    middles = low + (np.array([r["bin"] for r in bins]) + 0.5) * (high - low) / BINS
    return Model(mean, scale, weights, middles, values)


def score_of(model: Model, described: Column) -> Column:
    def run(values: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(values.to_list())) if len(values) else [], dtype=float)

    return F.pandas_udf(run, "double")(described)


def with_labels(described: DataFrame, labels: DataFrame) -> DataFrame:
    """``described`` (doc_id, statistics) with the labels of documents outside the held-out fold.

    Several labels of one doc_id are averaged and rounded up from a half; NULL ids and labels
    teach nothing. Other columns of the labels are not read.
    """
    chosen = labels.filter(id_remainder(F.col("doc_id"), FOLDS) != HELD_OUT).groupBy("doc_id") \
        .agg((F.avg("quality") >= 0.5).cast("double").alias("quality")).filter("quality IS NOT NULL")
    return described.select("doc_id", "statistics").join(chosen, "doc_id")


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Model, DataFrame]:
    """The model, and the statistics of all of ``docs`` (doc_id, text), written once."""
    described = stage(docs.select("doc_id", statistics_of(F.col("text")).alias("statistics")), "statistics")
    return train(stage(with_labels(described, labels), "labelled")), described


def quality_model_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the classifier scores 0.5 or more.

    It learns from all labelled documents, also from those that earlier stages dropped: they are
    most of the bad examples. NULL and empty texts are scored like others; rows are independent of each other, and all
    input columns are kept, whatever their names.
    """
    model, _ = fit(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))
    rows = docs.select(F.struct("*").alias("row"))
    score = score_of(model, statistics_of(F.col("row.text")))
    return rows.withColumn("score", score).filter("score >= 0.5").select("row.*")


def op9_quality_model(spark, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    model, described = fit(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))
    held_out = F.coalesce(id_remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return described.select(
        "doc_id", held_out.alias("held_out"), score_of(model, F.col("statistics")).alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
