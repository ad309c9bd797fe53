"""Isolation forest as tables: trees grown level by level, paths walked by joins with the node table.

The forest follows Liu, Ting and Zhou (2008). Every choice is drawn from an md5 of (seed, tree, node or row), so the forest is
the same under any partitioning, after any retry, and in any other engine that follows the same rule:

* a tree's sample are its rows with the smallest ``draw(seed, tree, row key)``;
* node 1 holds the sample, and node n passes its rows on to 2n and 2n + 1;
* a node is split while it has more than one row, some feature that varies, and depth left: the varying feature at place
  ``floor(u * how many vary)``, at ``low + u' * (high - low)``, rows at or below it going to 2n.

All trees grow at once, a level being one window over (tree, node). Rows are dealt out by tree once, at most ``subsample``
of them a tree, and all levels follow in place. Scoring explodes the rows into (row, tree) and walks a level per join with the
inner nodes, of which there are fewer than ``trees * subsample``: a bounded table that every task can have.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed value: Euler's constant, of the expected depth of a search tree.
EULER = 0.5772156649015329


def draw(*parts: Column | int | str) -> Column:
    """A number from 0 to 1, evenly drawn by the md5 of the parts."""
    text = F.concat_ws("|", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / float(16**12)


def average_path(n: Column) -> Column:
    """Expected path length of an unsuccessful search among n rows."""
    rows = n.cast("double")
    long = 2.0 * (F.ln(rows - 1.0) + EULER) - 2.0 * (rows - 1.0) / rows
    return F.when(n <= 1, 0.0).when(n == 2, 1.0).otherwise(long)


def depth_cap(size: int) -> int:
    return math.ceil(math.log2(max(size, 2)))


def row_key(key: list[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key])


def tree_subsamples(features: DataFrame, rows: int, key: list[str], columns: list[str], trees: int, subsample: int, seed: int) -> DataFrame:
    """(tree, _place, feature columns): the rows with the smallest draw per tree.

    Each row first drops out of all trees where its draw is too large to be among
    the smallest, keeping about four candidates per place, so what is shuffled
    and ranked is bounded by the forest, not by the rows.
    """
    share = min(1.0, 4.0 * subsample / max(rows, 1))
    drawn = features.select(*columns, row_key(key).alias("_key"))
    draws = F.transform(
        F.sequence(F.lit(0), F.lit(trees - 1)), lambda tree: F.struct(tree.alias("tree"), draw(seed, tree, F.col("_key")).alias("_draw"))
    )
    # Most rows are drawn by no tree; only the trees that draw a row make a copy of it.
    won = draws if share >= 1.0 else F.filter(draws, lambda d: d["_draw"] <= share)
    candidates = drawn.withColumn("_won", F.explode(won)).select(*columns, "_key", "_won.tree", "_won._draw")
    place = F.row_number().over(Window.partitionBy("tree").orderBy("_draw", "_key"))
    return candidates.withColumn("_place", place).where(F.col("_place") <= min(subsample, rows)).select("tree", "_place", *columns)


def fit_forest(features: DataFrame, rows: int, key: list[str], columns: list[str], trees: int, subsample: int, seed: int) -> DataFrame:
    """Node table (tree, node, depth, rows, feature, threshold, path): feature -1 and a path length at a leaf."""
    cap = depth_cap(min(subsample, rows))
    points = tree_subsamples(features, rows, key, columns, trees, subsample, seed).select(
        "tree", F.array(*columns).alias("_x"), F.lit(1).cast("long").alias("_node"), F.lit(True).alias("_open"),
        F.array().cast("array<struct<node: bigint, depth: int, rows: bigint, feature: int, threshold: double>>").alias("_trail"),
    )
    # As SQL text, which Spark parses faster than Python builds the same columns.
    n = len(columns)
    of_node = "over (partition by tree, _node)"

    def bound(which: str) -> str:
        return "array(" + ", ".join(f"{which}(_x[{k}]) {of_node}" for k in range(n)) + ")"

    def drawn(what: str) -> str:
        return f"conv(substring(md5(concat_ws('|', '{seed}', tree, _node, '{what}')), 1, 12), 16, 10) / {16**12}D"

    for depth in range(cap + 1):
        points = (
            points.selectExpr("*", f"count(*) {of_node} as _n", f"{bound('min')} as _low", f"{bound('max')} as _high")
            .selectExpr("*", f"filter(sequence(0, {n - 1}), k -> get(_high, k) > get(_low, k)) as _vary")
            .selectExpr(
                "*",
                f"if(_open and _n > 1 and size(_vary) > 0 and {depth} < {cap}, "
                f"get(_vary, cast(floor({drawn('feature')} * size(_vary)) as int)), -1) as _feature",
            )
            .selectExpr(
                "*", f"if(_feature >= 0, get(_low, _feature) + {drawn('threshold')} * (get(_high, _feature) - get(_low, _feature)), null) as _threshold"
            )
            .selectExpr(
                "tree",
                "_x",
                "if(_feature >= 0, 2 * _node + cast(get(_x, _feature) > _threshold as bigint), _node) as _node",
                "_feature >= 0 as _open",
                f"if(_open, array_append(_trail, named_struct('node', _node, 'depth', {depth}, 'rows', _n, 'feature', _feature, "
                "'threshold', _threshold)), _trail) as _trail",
            )
        )
    nodes = points.select("tree", F.inline("_trail")).groupBy("tree", "node").agg(
        *[F.first(c).alias(c) for c in ("depth", "rows", "feature", "threshold")]
    )
    return nodes.withColumn("path", F.when(F.col("feature") < 0, F.col("depth") + average_path(F.col("rows"))))


def forest_scores(features: DataFrame, nodes: DataFrame, rows: int, columns: list[str], trees: int, subsample: int) -> DataFrame:
    """Input rows plus ``isolation``, 2 ** (-mean path / expected path): near 1 is isolated early.

    Twelve decimals are kept, so that sums in another order give equal scores.
    """
    size = min(subsample, rows)
    inner = F.broadcast(nodes.where("feature >= 0").select(F.col("tree").alias("_t"), F.col("node").alias("_at"), "feature", "threshold"))
    leaves = F.broadcast(nodes.where("feature < 0").select(F.col("tree").alias("_t"), F.col("node").alias("_at"), "path"))
    walks = features.select(
        F.struct(*[F.col(f"`{c}`") for c in features.columns]).alias("_row"), F.monotonically_increasing_id().alias("_id"), F.array(*columns).alias("_x")
    ).withColumn("_tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn("_node", F.lit(1).cast("long"))
    here = (F.col("_t") == F.col("_tree")) & (F.col("_at") == F.col("_node"))
    for _ in range(depth_cap(size)):
        child = 2 * F.col("_node") + (F.get("_x", F.col("feature")) > F.col("threshold")).cast("long")
        walks = walks.join(inner, here, "left").select(
            "_row", "_id", "_x", "_tree", F.coalesce(child, F.col("_node")).alias("_node")
        )
    ended = walks.join(leaves, here).groupBy("_id").agg(F.first("_row").alias("_row"), F.sum("path").alias("_paths"))
    expected = F.greatest(average_path(F.lit(size)), F.lit(1e-12))
    return ended.select("_row.*", F.round(F.pow(F.lit(2.0), -(F.col("_paths") / trees) / expected), 12).alias("isolation"))
