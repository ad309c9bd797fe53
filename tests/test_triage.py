import hashlib
import math
import random
from datetime import date
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyward.operators import forest, triage

SCHEMA = (
    "anomaly_id string, source_file string, report_date date, anomaly_score decimal(6,2), risk_band string, "
    "primary_driver string, recommended_action string, total_bet_rows long, total_issue_rows long, "
    "duplicate_ratio decimal(18,4), negative_stake_ratio decimal(18,4), issue_ratio decimal(18,4), "
    "payout_ratio decimal(18,4), alert_count long, critical_alert_count long, net_revenue_amount decimal(24,2)"
)
D = Decimal


def normal(i):
    return (
        f"n{i}", f"normal_{i:02d}.csv", date(2026, 3, i + 1), D(2 + i % 3), "normal", "none", "No action required",
        100 + i, i % 2, D(0), D(0), D("0.01"), D("0.72"), 0, 0, D(1800 + i),
    )


def extreme(score="95.25", file="demo.csv"):
    return (
        "x", file, date(2026, 3, 31), D(score), "critical", "duplicate_pressure", "Immediate review", 600, 341,
        D("0.4033"), D("0.1017"), D("0.5683"), D("1.5755"), 3, 1, D("-34582.40"),
    )


def card(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_extreme_day_comes_first(spark):
    rows = triage.ml_scores(card(spark, *[normal(i) for i in range(20)], extreme())).collect()
    assert len(rows) == 21 and rows[0].__fields__ == triage.ML_COLUMNS
    top = rows[0]
    assert (top.source_file, top.model_outlier_flag, top.ml_risk_band) == ("demo.csv", True, "critical")
    assert top.ml_anomaly_score == 100.0
    assert top.recommended_action.startswith("Investigate immediately")
    assert all(0 <= r.ml_anomaly_score <= 100 for r in rows)
    assert [r.ml_anomaly_score for r in rows] == sorted((r.ml_anomaly_score for r in rows), reverse=True)


def test_single_row_keeps_its_rule_score(spark):
    row = triage.ml_scores(card(spark, extreme())).first()
    assert (row.ml_anomaly_score, row.model_outlier_flag, row.model_driver) == (95.25, True, "rule anomaly score")


@pytest.mark.parametrize("n", [2, 3])
def test_small_batches_stretch_to_the_full_range(spark, n):
    rows = triage.ml_scores(card(spark, *[normal(i) for i in range(n - 1)], extreme())).collect()
    assert rows[0].ml_anomaly_score == 100.0 and rows[0].model_outlier_flag
    assert rows[-1].ml_anomaly_score == 0.0


def test_empty_scorecard(spark):
    assert triage.ml_scores(card(spark).limit(0)).count() == 0


def test_equal_rows_fall_back_to_the_rule_score(spark):
    rows = [normal(0)[:1] + (f"f{i}.csv",) + normal(0)[2:] for i in range(6)]
    got = triage.ml_scores(card(spark, *rows)).collect()
    assert {r.ml_anomaly_score for r in got} == {2.0}
    assert not any(r.model_outlier_flag for r in got)


def test_null_payout_ratio_is_feature_zero(spark):
    row = list(extreme())
    row[12] = None
    features = triage.with_features(card(spark, tuple(row))).first()
    assert features.f_payout_ratio == 0.0
    assert features.f_net_revenue_amount == pytest.approx(-10.451, abs=1e-3)


def big_card(spark, n):
    rule = (F.col("id") * 37 % 1000) / 20
    return spark.range(n).select(
        F.concat(F.lit("a"), "id").alias("anomaly_id"),
        F.concat(F.lit("f"), F.col("id") % 50, F.lit(".csv")).alias("source_file"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") / 50).cast("int")).alias("report_date"),
        rule.cast("decimal(6,2)").alias("anomaly_score"),
        F.lit("low").alias("risk_band"),
        F.lit("none").alias("primary_driver"),
        F.lit("x").alias("recommended_action"),
        (F.col("id") * 7919 % 5000).alias("total_bet_rows"),
        (F.col("id") * 104729 % 97).alias("total_issue_rows"),
        *[
            ((F.col("id") * k % 1000) / 1000).cast("decimal(18,4)").alias(c)
            for k, c in ((13, "duplicate_ratio"), (17, "negative_stake_ratio"), (19, "issue_ratio"), (23, "payout_ratio"))
        ],
        (F.col("id") % 4).alias("alert_count"),
        (F.col("id") % 2).alias("critical_alert_count"),
        (F.col("id") * 31 % 9973 - 5000).cast("decimal(24,2)").alias("net_revenue_amount"),
    )


def test_subsamples_are_bounded_full_and_repeatable(spark):
    n = 6000
    features = triage.with_features(big_card(spark, n))
    key = ["source_file", "report_date"]
    first = forest.tree_subsamples(features, n, key, triage.FEATURE_COLUMNS, 20, 256, 42)
    sizes = {r.tree: r["count"] for r in first.groupBy("tree").count().collect()}
    assert set(sizes.values()) == {256} and len(sizes) == 20
    again = forest.tree_subsamples(features.repartition(7), n, key, triage.FEATURE_COLUMNS, 20, 256, 42)
    assert first.exceptAll(again).count() == 0


def test_scores_do_not_depend_on_partitioning(spark):
    base = big_card(spark, 3000)
    columns = ["source_file", "report_date", "ml_anomaly_score", "model_outlier_flag", "model_driver"]
    one = triage.ml_scores(base, trees=25).select(*columns).toPandas()
    two = triage.ml_scores(base.repartition(9), trees=25).select(*columns).toPandas()
    pd.testing.assert_frame_equal(one, two)
    # contamination 0.05: the cut itself flags one row in twenty
    assert 140 <= one.model_outlier_flag.sum()
    assert one.ml_anomaly_score.max() == 100.0 and one.ml_anomaly_score.min() == 0.0


def drawn(*parts):
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:12], 16) / 16**12


def expected_path(n):
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (math.log(n - 1) + forest.EULER) - 2 * (n - 1) / n


def grow(tree, points, cap, seed=42):
    """The same forest, one node after the other."""
    out, pending = {}, [(1, 0, points)]
    while pending:
        node, depth, rows = pending.pop()
        lows, highs = [min(c) for c in zip(*rows)], [max(c) for c in zip(*rows)]
        vary = [k for k in range(len(lows)) if highs[k] > lows[k]]
        if depth == cap or len(rows) == 1 or not vary:
            out[node] = (depth, len(rows), -1, None, depth + expected_path(len(rows)))
            continue
        k = vary[int(drawn(seed, tree, node, "feature") * len(vary))]
        at = lows[k] + drawn(seed, tree, node, "threshold") * (highs[k] - lows[k])
        out[node] = (depth, len(rows), k, at, None)
        pending += [(2 * node, depth + 1, [r for r in rows if r[k] <= at]), (2 * node + 1, depth + 1, [r for r in rows if r[k] > at])]
    return out


def test_forest_equals_one_grown_node_by_node(spark):
    draw = random.Random(4)
    rows = [(f"f{i}", draw.choice([0.0, 1.0, draw.random()]), float(i % 5), 3.0) for i in range(90)] + [("same", 0.5, 1.0, 3.0)] * 3
    rows = [(f"{r[0]}-{i}", *r[1:]) for i, r in enumerate(rows)]
    columns, trees, subsample = ["a", "b", "c"], 6, 64
    features = spark.createDataFrame(rows, "key string, a double, b double, c double").repartition(5)
    nodes = forest.fit_forest(features, len(rows), ["key"], columns, trees, subsample, 42)
    got = {}
    for r in nodes.collect():
        got.setdefault(r["tree"], {})[r["node"]] = (r["depth"], r["rows"], r["feature"], r["threshold"], r["path"])
    want = {}
    for tree in range(trees):
        sample = sorted(rows, key=lambda r: drawn(42, tree, r[0]))[:subsample]
        want[tree] = grow(tree, [r[1:] for r in sample], 6)
    assert {t: {n: v[:4] for n, v in ns.items()} for t, ns in got.items()} == {t: {n: v[:4] for n, v in ns.items()} for t, ns in want.items()}
    scores = {r["key"]: r["isolation"] for r in forest.forest_scores(features, nodes, len(rows), columns, trees, subsample).collect()}
    for key, *x in rows:
        total = 0.0
        for tree in range(trees):
            node = 1
            while want[tree][node][2] >= 0:
                _, _, k, at, _ = want[tree][node]
                node = 2 * node + (x[k] > at)
            total += want[tree][node][4]
        assert scores[key] == pytest.approx(2 ** -(total / trees / expected_path(subsample)), abs=1e-11)


def test_path_lengths(spark):
    got = [r[0] for r in spark.createDataFrame([(n,) for n in (1, 2, 256)], "n long").select(forest.average_path(F.col("n"))).collect()]
    assert got[:2] == [0.0, 1.0] and got[2] == pytest.approx(10.244, abs=1e-2)
