"""Quality classifier: ridge scores on random Fourier features of document statistics, calibrated.

1. Statistics of every document, in one pass over its text, written once.
2. Means and spreads of the training rows, as sums.
3. ``z = cos(W x + b)`` with Gaussian ``W`` approximates a Gaussian kernel. Each partition sums its
   ``Z'Z`` and ``Z'y``; the driver adds a bounded number of such matrices and solves them.
4. Isotonic regression maps ridge scores, counted in bins, to probabilities.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log1p

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataroll.llm.common import by_batch, saved, text_or_empty, texts_of

FEATURES = (
    "log_bytes", "log_words", "log_lines", "word_bytes", "upper", "digit", "space", "not_ascii",
    "stops", "bars", "symbols", "distinct_words", "top_word", "repeated_next", "distinct_lines",
    "capital_words", "ended_words", "short_words", "long_words",
)
FOURIER = 256
#: Width of the kernel in standardised statistics, and the ridge penalty a row.
WIDTH, PENALTY = 6.0, 1e-4
#: Partial matrices that reach the driver: 0.6 MB each, however many rows there are. Tasks make one for so many rows
#: at least; where there are more of them, they meet in PARTS tasks first.
PARTS, PART_ROWS = 24, 250_000
#: Bins a unit of ridge score for the calibration; scores are held to -1 to 2.
BINS = 1000
#: Part of the ridge score in the result, so that scores within a calibrated step keep their order.
TIE = 0.001
SEED = 7
STOPS, BARS, SPACES = b".,;:?", b"|\\{}<>[]", b" \t\n\v\f\r"
SYMBOLS = b"!#$%&*+=@^_~/-"


def statistics(text: str) -> list[float]:
    """The features of one text, from all of it; all zero for an empty one."""
    data = text.encode()
    words = data.split()
    if not words:
        return [log1p(len(data)), *[0.0] * (len(FEATURES) - 1)]
    n, k = len(data), len(words)
    bytes_ = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    share = lambda chars: float(bytes_[np.frombuffer(chars, np.uint8)].sum()) / n
    lines = [line for line in data.split(b"\n") if line.strip()]
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, k)
    return [
        log1p(n), log1p(k), log1p(len(lines)), float(lengths.mean()),
        float(bytes_[65:91].sum()) / n, float(bytes_[48:58].sum()) / n, share(SPACES),
        float(bytes_[128:].sum()) / n, share(STOPS) * n / k, share(BARS) * n / k,
        share(SYMBOLS) * n / k, len(counts) / k, max(counts.values()) / k,
        sum(map(operator.eq, words, words[1:])) / k, len(set(lines)) / len(lines),
        sum(65 <= w[0] <= 90 for w in words) / k, sum(w[-1] in b".!?" for w in words) / k,
        float((lengths <= 2).mean()), float((lengths >= 12).mean()),
    ]


@dataclass(frozen=True)
class Model:
    """Everything a score needs; its size does not depend on the data."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    shift: np.ndarray
    beta: np.ndarray
    steps: np.ndarray  # of the ridge score
    values: np.ndarray  # calibrated, at the steps

    def expand(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features, the standardised statistics themselves, and a constant."""
        x = np.clip((np.nan_to_num(x) - self.mean) / self.spread, -8, 8)
        z = np.cos(x @ self.weights + self.shift) * np.sqrt(2 / FOURIER)
        return np.hstack([z, x, np.ones((len(x), 1))])

    def ridge(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.expand(x) @ self.beta, -1, 2)

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.ridge(x)
        return (1 - TIE) * np.interp(raw, self.steps, self.values) + TIE * (raw + 1) / 3


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("features").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, len(FEATURES))


def document_statistics(docs: DataFrame, *keep: Column, text_col: str = "text") -> DataFrame:
    """The kept columns and ``features`` of each row; no shuffle."""
    rows = docs.select(*keep, text_or_empty(text_col).alias("text"))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = pa.array([statistics(t) for t in texts_of(batch, "text")], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], found], [*batch.schema.names[:-1], "features"]
        )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return by_batch(rows, step, f"{fields}, features array<double>")


def _sums(train: DataFrame, expand, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of z z' and of z y over all rows: a matrix from each task, where its rows lie, and of many tasks from few."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square, right = np.zeros((width, width)), np.zeros(width)
        for batch in batches:
            z = expand(_matrix(batch))
            square += z.T @ z
            right += z.T @ batch.column("label").to_numpy(zero_copy_only=False)
        both = np.column_stack([square, right])
        part = TaskContext.get().partitionId() if TaskContext.get() else 0
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([both.tobytes()], pa.binary())], ["part", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width * (width + 1))
        for batch in batches:
            for sums in batch.column("sums"):
                total += np.frombuffer(sums.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    tasks = max(PARTS, -(-train.count() // PART_ROWS))
    sums = train.select("features", "label").coalesce(tasks).mapInArrow(run, "part bigint, sums binary")
    if tasks > PARTS:
        sums = sums.repartition(PARTS, "part").mapInArrow(add, "sums binary")
    total = np.zeros((width, width + 1))
    for row in sums.select("sums").collect():
        total += np.frombuffer(row["sums"]).reshape(width, width + 1)
    return total[:, :-1], total[:, -1]


def isotonic(at: np.ndarray, value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The weighted least-squares fit that does not fall, by pooling adjacent violators."""
    blocks: list[list[float]] = []
    for v, w in zip(value, weight, strict=True):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def fit(stats: DataFrame, labels: DataFrame) -> Model:
    """A model from ``stats`` (``doc_id, features``) and ``labels`` (``doc_id, label``).

    Of every five labelled rows by the hash of the id, four fit the ridge and one the
    calibration. Without labels every score is 0.5, give or take the tie part.
    """
    rows = saved(
        stats.join(labels, "doc_id").select(
            "features", "label", F.pmod(F.xxhash64("doc_id"), F.lit(5)).alias("part")
        ),
        "quality-train",
    )
    train, calibrate = rows.filter("part > 0"), rows.filter("part = 0")
    d = len(FEATURES)
    with_one = lambda x: np.hstack([x, np.ones((len(x), 1))])
    square, right = _sums(train, with_one, d + 1)
    n = max(square[-1, -1], 1.0)
    mean = square[-1, :-1] / n
    spread = np.sqrt(np.maximum(np.diag(square)[:-1] / n - mean**2, 0)) + 1e-9
    spread[spread < 1e-6] = 1.0
    random = np.random.default_rng(SEED)
    model = Model(
        mean, spread, random.normal(0, 1 / WIDTH, (d, FOURIER)), random.uniform(0, 2 * np.pi, FOURIER),
        np.zeros(FOURIER + d + 1), np.array([-1.0, 2.0]), np.array([0.5, 0.5]),
    )
    if square[-1, -1] == 0:
        return model
    square, right = _sums(train, model.expand, FOURIER + d + 1)
    beta = np.linalg.solve(square + np.eye(len(square)) * (1e-6 + PENALTY * n), right)
    model = Model(model.mean, model.spread, model.weights, model.shift, beta, model.steps, model.values)

    def ridges(batch: pa.RecordBatch) -> pa.RecordBatch:
        bins = np.round(model.ridge(_matrix(batch)) * BINS).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(bins), batch.column("label")], ["bin", "label"])

    binned = by_batch(calibrate.select("features", "label"), ridges, "bin bigint, label double")
    counted = binned.groupBy("bin").agg(F.avg("label").alias("v"), F.count("*").alias("w")).collect()
    if not counted:
        prior = float(right[-1] / n)
        return Model(*list(vars(model).values())[:6], np.array([prior, prior]))
    counted.sort(key=lambda r: r["bin"])
    at = np.array([r["bin"] / BINS for r in counted])
    values = isotonic(at, np.array([r["v"] for r in counted]), np.array([r["w"] for r in counted]))
    return Model(*list(vars(model).values())[:5], at, values)


def score_rows(stats: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = np.clip(shared.value.score(_matrix(batch)), 0, 1)
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in keep), pa.array(scores)], [*keep, "score"]
        )

    fields = ", ".join(f"`{c}` {stats.schema[c].dataType.simpleString()}" for c in keep)
    return by_batch(stats.select(*keep, "features"), step, f"{fields}, score double")


def usable_labels(labels: DataFrame) -> DataFrame:
    """``doc_id, label`` of the rows to learn from: both there, and not held out."""
    ids = F.col("doc_id").cast("bigint")
    return labels.select(ids.alias("doc_id"), F.col("quality").cast("double").alias("label")).filter(
        F.col("label").isin(0.0, 1.0) & (fold(F.col("doc_id")) != 0)
    )


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``.

    Null texts count as empty; empty texts have a score like any other. Null ids stay null and are
    not held out. Repeated ids are scored each, and each meets the labels of its id. Labels other
    than 0 and 1 are not used. Empty tables give no rows, or scores of about 0.5 without labels.
    """
    doc_id = F.col("doc_id").cast("bigint").alias("doc_id")
    stats = saved(document_statistics(docs, doc_id), "quality-stats")
    scored = score_rows(stats, fit(stats, usable_labels(labels)), ["doc_id"])
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score at least the threshold, with all their columns.

    The model learns from the statistics; the rows are then scored where they are read, so no text
    is shuffled.
    """
    doc_id = F.col("doc_id").cast("bigint").alias("doc_id")
    model = fit(saved(document_statistics(docs, doc_id), "quality-stats"), usable_labels(labels))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([statistics(t or "") for t in texts_of(batch, "text")])
        return batch.filter(pa.array(np.clip(shared.value.score(found), 0, 1) >= threshold))

    return by_batch(docs, step, docs.schema)
