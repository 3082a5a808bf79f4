"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each document gives a vector of statistics (``STATISTICS``), ratios under a square root and counts under a
logarithm, so that each class is nearer to a Gaussian.  Every class has a mean and a covariance; the
covariance is shrunk towards the pooled one and then towards a multiple of the identity.  Its Cholesky factor L is
kept inverted, so a document's Mahalanobis distance is the squared length of L^-1 (x - mean), and the score is the
logistic of the difference of the classes' log densities and log shares.

Scale: texts are read once, by DataFrame functions, into a written table of ``STATISTICS`` numbers a document; training
joins that with the labels and adds up one count, mean and moment matrix a class, with partial sums in the tasks; the
model that goes to the tasks has two such matrices whatever the corpus.

Defined cases: null text counts as empty; an empty text has zero for every statistic and is scored like any other;
rows without id match no label; an id with several labels counts once for each; repeated rows are scored and, if
labelled, counted each by itself; labels other than 0 and 1 are not used; without labelled rows of both classes every
score is (n1 + 1) / (n + 2) of the rows there are; texts of any length are measured whole; other columns
are not read; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, words, written

POOLED = 0.05            # weight of the pooled covariance in a class's
IDENTITY = 0.01          # weight of the mean variance on the diagonal
LEAST_VARIANCE = 1e-6
SYMBOLS = r"#*$%&|<>{}\\/=_~^@+"
THRESHOLD = 0.3

#: Statistics in order: transform and meaning.
STATISTICS = [
    "log words", "log different words / log words", "log mean word length", "root of symbols / characters",
    "root of capitals / letters", "root of digits / characters", "root of exclamation and question marks / words",
    "root of full stops and commas / words", "log words a line", "share of different lines", "root of words without a letter / words",
    "root of words equal to the one before / words", "root of capitalised words / words", "root of rest characters / characters",
]


def ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def statistics(text: Column) -> Column:
    """Array of the document's transformed statistics."""
    text = F.coalesce(text, F.lit(""))
    count = lambda chars: F.length(F.regexp_replace(text, f"[^{chars}]+", "")).cast("double")
    root = lambda a, b: F.sqrt(ratio(a, b))

    def vector(m: Column) -> Column:
        n = m["chars"]
        rest = n - m["letters"] - m["digits"] - m["symbols"] - m["marks"] - m["stops"] - m["spaces"]
        return F.array(
            F.log1p(m["words"]), ratio(F.log1p(m["different"]), F.log1p(m["words"])), F.log1p(ratio(n - m["spaces"], m["words"])),
            root(m["symbols"], n), root(m["capitals"], m["letters"]), root(m["digits"], n), root(m["marks"], m["words"]),
            root(m["stops"], m["words"]), F.log1p(ratio(m["words"], m["lines"])), ratio(m["different_lines"], m["lines"]),
            root(m["bare"], m["words"]), root(m["again"], m["words"]), root(m["loud"], m["words"]), root(F.greatest(rest, F.lit(0.0)), n))

    def measure(w: Column) -> Column:
        some = lambda kept: F.size(kept).cast("double")
        return F.struct(
            some(w).alias("words"), some(F.array_distinct(w)).alias("different"),
            some(F.filter(w, lambda x: ~x.rlike(r"\p{L}"))).alias("bare"),
            some(F.filter(w, lambda x, i: F.get(w, i - 1) == x)).alias("again"),
            some(F.filter(w, lambda x: x.rlike(r"\p{Lu}.*\p{Lu}"))).alias("loud"))

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counts = lambda a: F.struct(F.size(a).cast("double").alias("lines"), F.size(F.array_distinct(a)).cast("double").alias("different_lines"))
    both = F.struct(
        let(words(text), measure).alias("w"), let(lines, counts).alias("l"), F.length(text).cast("double").alias("chars"),
        count(r"\p{L}").alias("letters"), count(r"\p{Lu}").alias("capitals"), count(r"0-9").alias("digits"), count(SYMBOLS).alias("symbols"),
        count("!?").alias("marks"), count(".,;:").alias("stops"), count(r"\x20\x09-\x0D").alias("spaces"))
    flat = lambda b: F.struct(*[b["w"][x].alias(x) for x in ("words", "different", "bare", "again", "loud")],
                              *[b["l"][x].alias(x) for x in ("lines", "different_lines")],
                              *[b[x].alias(x) for x in ("chars", "letters", "capitals", "digits", "symbols", "marks", "stops", "spaces")])
    return let(let(both, flat), vector)


@dataclass(frozen=True)
class Gaussian:
    """A class: log share less half the log determinant, mean, and the inverted Cholesky factor of its covariance."""
    constant: float
    mean: np.ndarray
    factor: np.ndarray

    def log_density(self, x: np.ndarray) -> np.ndarray:
        away = (x - self.mean) @ self.factor.T
        return self.constant - 0.5 * (away * away).sum(1)


@dataclass(frozen=True)
class Model:
    classes: tuple[Gaussian, Gaussian] | None
    share: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for rows of statistics."""
        if self.classes is None:
            return np.full(len(x), self.share)
        low, high = (c.log_density(x) for c in self.classes)
        return 1 / (1 + np.exp(np.clip(low - high, -700, 700)))


def moments(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per label its weight, the sum of its vectors and of their outer products, from rows (x, label, weight)."""
    size = len(STATISTICS) + 1

    def partial(batches):
        for b in batches:
            for label, own in b.groupby("label"):
                x = np.column_stack([np.ones(len(own)), np.vstack(own["x"])])
                m = (x * own["weight"].to_numpy()[:, None]).T @ x
                yield pd.DataFrame({"label": label, "place": np.arange(m.size), "value": m.ravel()})

    sums = (rows.select("x", "label", "weight").mapInPandas(partial, "label int, place int, value double")
            .groupBy("label", "place").agg(F.sum("value").alias("value")).collect())  # 2 x size^2 rows
    out: dict[int, np.ndarray] = {}
    for r in sums:
        out.setdefault(r["label"], np.zeros(size * size))[r["place"]] = r["value"]
    return {k: ((m := v.reshape(size, size))[0, 0], m[0, 1:], m[1:, 1:]) for k, v in out.items()}


def fit(rows: DataFrame, pooled: float = POOLED, identity: float = IDENTITY) -> Model:
    """The model of rows (x, label, weight); labels are 0 and 1."""
    got = moments(rows.where(F.col("label").isin(0, 1)))
    total = sum(n for n, _, _ in got.values())
    share = (got[1][0] if 1 in got else 0) + 1
    if len(got) < 2:
        return Model(None, share / (total + 2))
    means = {k: s / n for k, (n, s, _) in got.items()}
    scatter = {k: m - n * np.outer(means[k], means[k]) for k, (n, _, m) in got.items()}
    common = sum(scatter.values()) / total
    classes = []
    for k in (0, 1):
        n = got[k][0]
        cov = (1 - pooled) * scatter[k] / n + pooled * common
        spread = max(np.trace(cov) / len(cov), LEAST_VARIANCE)
        cov = (1 - identity) * cov + identity * spread * np.eye(len(cov))
        lower = np.linalg.cholesky(cov)
        classes.append(Gaussian(float(np.log(n / total) - np.log(np.diag(lower)).sum()), means[k], np.linalg.inv(lower)))
    return Model((classes[0], classes[1]), share / (total + 2))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x), written: each row's statistics."""
    return written(docs.select(F.col(id_col).cast("long").alias("id"), statistics(F.col(text_col)).alias("x")), "quality-statistics")


def train(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Model:
    """The model of measured ``rows`` (id, x) and their labels."""
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
    weights = known.where("id IS NOT NULL AND label IN (0, 1)").groupBy("id", "label").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    return fit(rows.join(weights, "id"))


def scores(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` (x, ...) with ``score``."""
    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.vstack(x)) if len(x) else [], dtype=float)

    return rows.withColumn("score", score("x"))
