"""Text quality by regularised quadratic discriminant analysis.

Every text is reduced to a short vector of transformed statistics. Each class keeps the
mean and the covariance of its vectors, the covariance shrunk towards the pooled one and
its diagonal. A text scores by the difference of the two Gaussian log-densities, for which
the Cholesky factors are inverted once, on the driver, when the model is made.

Defined results: a NULL text counts as empty; an empty text has the vector of zeros and a
score like any other. Repeated rows are scored each. Labels that are neither 0 nor 1 are
ignored, a document with several labels takes the one met more often (1 on a tie). Without
labels of both classes every text gets the same score, the smoothed share of label 1. Texts of
any length are read whole. Columns with the names of helper columns change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdgrid.llm.common import free_name
from crowdgrid.session import materialise, small_batches

SYMBOLS = b"#*$%&|<>"
STOPS = b".,;:"
NAMES = (
    "log_words", "word_chars", "upper", "lower", "digits", "symbols", "shouts", "stops",
    "other_ascii", "beyond_ascii", "distinct_words", "repeated_lines", "line_words", "longest",
)
CUT = 0.3
HELD_OUT_FOLDS = 5


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of one whole text, in the order of ``NAMES``.

    Shares go through arcsin of the root, which evens out the variance of a proportion;
    counts and lengths through the logarithm.
    """
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return [0.0] * len(NAMES)
    seen = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    space = int(seen[[9, 10, 11, 12, 13, 32]].sum())
    inked = max(1, len(raw) - space)
    upper, lower, digits = seen[65:91].sum(), seen[97:123].sum(), seen[48:58].sum()
    symbols = sum(int(seen[b]) for b in SYMBOLS)
    shouts = int(seen[33] + seen[63])
    stops = sum(int(seen[b]) for b in STOPS)
    beyond = seen[128:].sum()
    rest = inked - upper - lower - digits - symbols - shouts - stops - beyond
    lines = [line for line in raw.split(b"\n") if line.strip()]
    shares = [upper, lower, digits, symbols, shouts, stops, max(0, rest), beyond]
    return [
        float(np.log1p(len(words))),
        float(np.log(inked / len(words))),
        *[_angle(s / inked) for s in shares],
        _angle(len(set(words)) / len(words)),
        _angle(1 - len(set(lines)) / len(lines)),
        float(np.log1p(len(words) / len(lines))),
        float(np.log(max(map(len, words)))),
    ]


def _angle(share: float) -> float:
    return float(np.arcsin(np.sqrt(min(1.0, max(0.0, share)))))


@dataclass(frozen=True)
class Model:
    """Means and inverted Cholesky factors of both classes; ``flat`` where one is missing."""

    means: np.ndarray
    factors: np.ndarray
    offsets: np.ndarray
    temperature: float
    flat: float | None = None

    def score(self, vectors: np.ndarray) -> np.ndarray:
        if self.flat is not None:
            return np.full(len(vectors), self.flat)
        logs = []
        for mean, factor, offset in zip(self.means, self.factors, self.offsets):
            away = (vectors - mean) @ factor.T
            logs.append(offset - 0.5 * np.einsum("ij,ij->i", away, away))
        gap = (logs[1] - logs[0]) / self.temperature
        return 1.0 / (1.0 + np.exp(-np.clip(gap, -500, 500)))


def with_statistics(docs: DataFrame, name: str, text: str = "text") -> DataFrame:
    """Add the vector of each row's text as column ``name``."""
    small_batches(docs.sparkSession)

    @F.arrow_udf("array<double>")
    def measured(texts: pa.Array) -> pa.Array:
        return pa.array([statistics(t) for t in texts.to_pylist()], type=pa.list_(pa.float64()))

    return docs.withColumn(name, measured(F.col(text)))


def held_out(doc_id: Column, folds: int = HELD_OUT_FOLDS) -> Column:
    """True for the documents whose label no fit may see; a NULL id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def training_labels(labels: DataFrame) -> DataFrame:
    """One 0/1 ``quality`` for each labelled document outside the held-out fold."""
    usable = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").filter(
        ~held_out(F.col("doc_id"))
    )
    votes = usable.groupBy("doc_id").agg(F.avg(F.col("quality").cast("double")).alias("_vote"))
    return votes.select("doc_id", (F.col("_vote") >= 0.5).cast("int").alias("quality"))


def fit(
    measured: DataFrame,
    labels: DataFrame,
    shrink_to_pooled: float = 0.2,
    shrink_to_diagonal: float = 0.1,
    floor: float = 1e-4,
    temperature: float = float(len(NAMES)),
) -> Model:
    """Fit on all labelled rows of ``measured`` (doc_id, vector).

    Tasks reduce their rows to counts, sums and products, so the driver receives one
    matrix per class, whatever the number of rows.
    """
    rows = measured.join(training_labels(labels), "doc_id").select("quality", "vector")

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(NAMES) + 1
        total = np.zeros((2, width, width))
        for batch in batches:
            vectors = np.array(batch.column("vector").to_pylist(), dtype=float)
            quality = batch.column("quality").to_numpy(zero_copy_only=False)
            for c in (0, 1):
                mine = vectors[quality == c].reshape(-1, width - 1)
                wide = np.hstack([np.ones((len(mine), 1)), mine])
                total[c] += wide.T @ wide
        at = np.indices(total.shape).reshape(3, -1)
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(a.astype(np.int32)) for a in at), pa.array(total.ravel())],
            names=["c", "i", "j", "v"],
        )

    sums = rows.mapInArrow(moments, "c int, i int, j int, v double")
    total = np.zeros((2, len(NAMES) + 1, len(NAMES) + 1))
    for r in sums.groupBy("c", "i", "j").agg(F.sum("v").alias("v")).collect():
        total[r.c, r.i, r.j] = r.v
    return _model(total, shrink_to_pooled, shrink_to_diagonal, floor, temperature)


def _model(
    total: np.ndarray, to_pooled: float, to_diagonal: float, floor: float, temperature: float
) -> Model:
    counts = total[:, 0, 0]
    if min(counts) < 2:
        flat = float((counts[1] + 1) / (counts.sum() + 2))
        none = np.zeros(0)
        return Model(none, none, none, temperature, flat)
    means = total[:, 0, 1:] / counts[:, None]
    scatter = np.array(
        [t[1:, 1:] - n * np.outer(m, m) for t, n, m in zip(total, counts, means)]
    )
    pooled = scatter.sum(axis=0) / counts.sum()
    factors, offsets = [], []
    for c in (0, 1):
        own = (1 - to_pooled) * scatter[c] / counts[c] + to_pooled * pooled
        own = (1 - to_diagonal) * own + to_diagonal * np.diag(np.diag(own))
        chol = np.linalg.cholesky(own + floor * np.eye(len(own)))
        factors.append(np.linalg.inv(chol))
        offsets.append(np.log(counts[c] / counts.sum()) - np.log(np.diag(chol)).sum())
    return Model(means, np.array(factors), np.array(offsets), temperature)


def score_of(model: Model, vector: Column) -> Column:
    """Score between 0 and 1 of a vector column; higher means label 1 is likelier."""

    @F.arrow_udf("double")
    def scored(vectors: pa.Array) -> pa.Array:
        return pa.array(model.score(np.array(vectors.to_pylist(), dtype=float).reshape(-1, len(NAMES))))

    return scored(vector)


def classify(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    The vectors are written once to the shared folder, as fitting and scoring both need them.
    """
    measured = materialise(
        with_statistics(docs.select("doc_id", "text"), "vector").select("doc_id", "vector")
    )
    model = fit(measured, labels)
    return measured.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score_of(model, F.col("vector")).alias("score")
    ).withColumn("predicted", (F.col("score") >= cut).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` that the classifier predicts as label 1, all columns unchanged.

    The fit reads the labelled texts only; the texts are then scored where they lie.
    """
    labelled = docs.select("doc_id", "text").join(
        training_labels(labels).select("doc_id"), "doc_id", "left_semi"
    )
    model = fit(with_statistics(labelled, "vector"), labels)
    name = free_name(docs, "llm_vector")
    scored = with_statistics(docs, name)
    return scored.filter(score_of(model, F.col(name)) >= cut).drop(name)
