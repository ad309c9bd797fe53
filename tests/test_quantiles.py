import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyward.operators import quantiles


@pytest.mark.parametrize("bracketed", [False, True])
@pytest.mark.parametrize("q", [0.0, 0.05, 0.5, 0.8, 0.95, 1.0])
def test_matches_linear_interpolation(spark, monkeypatch, bracketed, q):
    n = 30000 if bracketed else 85
    monkeypatch.setattr(quantiles, "SMALL_ROWS", 20000)
    rng = np.random.default_rng(int(q * 100))
    smooth = rng.normal(size=n)
    # A third of the rows share one value, and the rest are few distinct ones.
    lumpy = np.where(rng.random(n) < 0.34, 7.0, rng.integers(0, 9, n)).astype(float)
    df = spark.createDataFrame(
        __import__("pandas").DataFrame({"smooth": smooth, "lumpy": lumpy})
    ).repartition(6)
    row = quantiles.exact_quantile(df, ["smooth", "lumpy"], q).first()
    assert row.smooth == pytest.approx(np.quantile(smooth, q), abs=1e-12)
    assert row.lumpy == pytest.approx(np.quantile(lumpy, q), abs=1e-12)


def test_bracket_keeps_few_values(spark):
    df = spark.range(200000).select(F.col("id").cast("double").alias("x"))
    assert quantiles.exact_quantile(df, ["x"], 0.5).first().x == 99999.5


def test_several_at_once_and_split_tally(spark):
    values = np.random.default_rng(3).normal(size=3000)
    df = spark.createDataFrame(__import__("pandas").DataFrame({"x": values})).repartition(3)
    wanted = [(f"q{k}", "x", q) for k, q in enumerate((0.0, 0.1, 0.5, 0.9, 1.0))]
    for small_rows in (0, 20000):
        row = quantiles.exact_quantiles(df, wanted, small_rows).first()
        inner = range(5) if small_rows else (0, 2, 4)
        for k in inner:
            assert row[f"q{k}"] == pytest.approx(np.quantile(values, wanted[k][2]), abs=1e-12)
