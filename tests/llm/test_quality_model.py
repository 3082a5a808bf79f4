"""op13: held-out accuracy, the discriminant against a direct computation, odd tables."""

import numpy as np
import pytest

from gearwatch.llm import quality_model
from pyspark.sql import functions as F

from ..conftest import SMALL
from .small import LABELS, documents, folder, run

BIG = 2**53 + 1


def test_held_out_rows(spark):
    got = {r["doc_id"]: r for r in run(spark, "op13_quality_classifier", SMALL).collect()}
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").collect()
    held = [(got[r["doc_id"]]["predicted"], r["quality"]) for r in labels if got[r["doc_id"]]["held_out"]]
    assert len(held) > 50
    assert np.mean([a == b for a, b in held]) >= 0.97
    assert np.mean([a for a, b in held if b == 1]) >= 0.97 and np.mean([a for a, b in held if b == 0]) <= 0.05


def test_fit_and_score_equal_a_direct_computation(spark):
    rnd = np.random.RandomState(1)
    k = len(quality_model.STATISTICS)
    x = np.vstack([rnd.randn(60, k), rnd.randn(90, k) * 2 + 1])
    y = [0] * 60 + [1] * 90
    rows = spark.createDataFrame([(v.tolist(), int(c), 1.0) for v, c in zip(x, y, strict=True)], "x array<double>, label int, weight double")
    model = quality_model.fit(rows.repartition(7))
    low, high = x[:60], x[60:]
    within = sum((a - a.mean(0)).T @ (a - a.mean(0)) for a in (low, high)) / 150
    density = []
    for own in (low, high):
        cov = 0.95 * np.cov(own.T, bias=True) + 0.05 * within
        cov = 0.99 * cov + 0.01 * np.trace(cov) / k * np.eye(k)
        away = x - own.mean(0)
        density.append(np.log(len(own) / 150) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", away, np.linalg.inv(cov), away))
    assert np.allclose(model.score(x), 1 / (1 + np.exp(density[0] - density[1])), atol=1e-9)


def test_statistics_of_a_text(spark):
    text = "Ab ab ab, 12 $$!\n\nAB ab\nAB ab"
    x = spark.createDataFrame([(text,)], "t string").select(quality_model.statistics(F.col("t"))).first()[0]
    n, w = len(text), 9
    want = [np.log1p(w), np.log1p(6) / np.log1p(w), np.log1p((n - 9) / w), np.sqrt(2 / n), np.sqrt(5 / 14), np.sqrt(2 / n), np.sqrt(1 / w),
            np.sqrt(1 / w), np.log1p(w / 3), 2 / 3, np.sqrt(2 / w), 0.0, np.sqrt(2 / w), 0.0]
    assert np.allclose(x, want)


def good(i):
    return " ".join(f"word{i}a plain{j} text" for j in range(5 + i % 7)) + "."


@pytest.mark.parametrize("clash", [False, True])
def test_odd_rows(spark, tmp_path, clash):
    docs = [(i, good(i) if i % 3 else "$$$ " * (i + 4), "en", "s") for i in range(60)]
    docs += [(BIG, "$$$ $$$ ### $$$", None, None), (BIG + 2, "", "en", "s"), (None, None, None, None), (None, "### $$$ ***", None, None),
             (7, good(7), "en", "s"), (7, "$$$ " * 9, "en", "s"), (99, good(1) * 20_000, "en", "s")]
    labels = [(i, int(i % 3 > 0), 0) for i in range(60)] + [(None, 0, 0), (8, None, 0), (9, 5, 0), (10, 1, 0), (10, 1, 1)]
    path = folder(spark, tmp_path, clash, documents=documents(docs), labels=(labels, LABELS))
    got = run(spark, "op13_quality_classifier", path).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((d[0] is None, d[0] or 0) for d in docs)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert {r["predicted"] for r in got if r["doc_id"] == BIG} == {0}
    assert {r["predicted"] for r in got if r["doc_id"] == 7} == {0, 1}
    assert {r["held_out"] for r in got if r["doc_id"] is None} == {False}


def test_without_labels_or_documents(spark, tmp_path):
    docs = documents([(1, "a b", "en", "s"), (2, None, None, None)])
    (tmp_path / "a").mkdir(), (tmp_path / "b").mkdir()
    got = run(spark, "op13_quality_classifier", folder(spark, tmp_path / "a", documents=docs, labels=([], LABELS))).collect()
    assert [r["score"] for r in got] == [0.5, 0.5]
    empty = folder(spark, tmp_path / "b", documents=([], docs[1]), labels=([(1, 1, 0)], LABELS))
    assert run(spark, "op13_quality_classifier", empty).collect() == []
