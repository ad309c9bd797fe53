"""WARC fixity audit with Merkle trees over ordered offset ranges.

Pages become response records, laid out in the order of their ids. A leaf is one id: its records' hashes, summed so that
the order and number of copies don't need a sort (a hot id stays one pre-aggregated row). A node of the next level covers
``2**BITS`` consecutive ids or nodes: it hashes its children in order and adds up their bytes, so every node is also an
offset range. ``LEVELS`` levels cover all 64-bit ids, and no group holds more than ``2**BITS`` rows.

Replicas are compared from the roots down: a level joins only the children of nodes that differed above it.

Defined cases: records without an id form a leaf of their own in front of all others; a null url or body is empty;
repeated rows are records like any other and count; other input columns are ignored; an empty table has no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.sources.shared import cut

BITS = 16
LEVELS = 4
NODE = ["no_id", "node"]


def record_text(page_id: Column, url: Column, body: Column) -> Column:
    """The record as text; its length counts bytes of the body."""
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(F.coalesce(body, F.lit(""))).cast("string"),
        F.lit("\r\n\r\n"), F.coalesce(body, F.lit("")), F.lit("\r\n\r\n"),
    )


def leaves(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """One row per id: (no_id, node), n_records, bytes, sha256 (the largest, if there are several), digest."""
    record = record_text(F.col(id_col), F.col(url_col).cast("string"), F.col(body_col).cast("string"))
    hashed = pages.select(F.col(id_col).cast("long").alias("id"), record.alias("record")).select(
        F.col("id").isNotNull().alias("no_id"),  # false sorts first
        F.coalesce("id", F.lit(0).cast("long")).alias("node"),
        F.octet_length("record").cast("long").alias("bytes"),
        F.sha2("record", 256).alias("sha256"),
    )
    words = [F.sum(F.conv(F.substring("sha256", 1 + 8 * k, 8), 16, 10).cast("long")).alias(f"w{k}") for k in range(8)]
    summed = hashed.groupBy(*NODE).agg(F.count("*").alias("n_records"), F.sum("bytes").alias("bytes"), F.max("sha256").alias("sha256"), *words)
    return summed.select(
        *NODE, "n_records", "bytes", "sha256", F.sha2(F.concat_ws(":", "n_records", *[f"w{k}" for k in range(8)]), 256).alias("digest")
    )


def level_above(nodes: DataFrame) -> DataFrame:
    children = F.array_sort(F.collect_list(F.struct("node", "digest")))
    return (
        nodes.groupBy("no_id", F.shiftright("node", BITS).alias("up"))
        .agg(F.sum("bytes").alias("bytes"), children.alias("children"))
        .select("no_id", F.col("up").alias("node"), "bytes", F.sha2(F.to_json("children"), 256).alias("digest"))
    )


def tree(pages: DataFrame, **names: str) -> list[DataFrame]:
    """Levels from the leaves up. Leaves and the first level are written, the rest is small."""
    levels = [cut(leaves(pages, **names), "leaves")]
    levels.append(cut(level_above(levels[0]), "nodes"))
    while len(levels) <= LEVELS:
        levels.append(level_above(levels[-1]))
    return levels


def offsets(levels: list[DataFrame]) -> DataFrame:
    """Leaves with the offset at which their records start in the archive."""
    above = None
    for nodes in reversed(levels):
        if above is None:  # at most two nodes for each of the two marks
            before = Window.orderBy(*NODE).rowsBetween(Window.unboundedPreceding, -1)
            above = nodes.withColumn("offset", F.coalesce(F.sum("bytes").over(before), F.lit(0)))
            continue
        siblings = Window.partitionBy("no_id", "up").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
        inside = nodes.withColumn("up", F.shiftright("node", BITS)).withColumn("within", F.coalesce(F.sum("bytes").over(siblings), F.lit(0)))
        starts = above.select("no_id", F.col("node").alias("up"), F.col("offset").alias("start"))
        above = inside.join(starts, ["no_id", "up"]).withColumn("offset", F.col("start") + F.col("within")).drop("up", "within", "start")
    return above


def audit(left: list[DataFrame], right: list[DataFrame]) -> DataFrame:
    """Leaves that differ: (no_id, node), damage: altered, missing (in the right tree) or extra (only there)."""
    differing = None
    for a, b in zip(reversed(left), reversed(right)):
        a, b = (side.select(*NODE, F.col("digest").alias(name)) for side, name in ((a, "ours"), (b, "theirs")))
        if differing is not None:
            parents = differing.select("no_id", F.col("node").alias("up"))
            a, b = (
                side.withColumn("up", F.shiftright("node", BITS)).join(parents, ["no_id", "up"], "left_semi").drop("up") for side in (a, b)
            )
        differing = a.join(b, NODE, "full_outer").where(~F.col("ours").eqNullSafe(F.col("theirs")))
    damage = F.when(F.col("theirs").isNull(), "missing").when(F.col("ours").isNull(), "extra").otherwise("altered")
    return differing.select(*NODE, damage.alias("damage"))


def fixity_report(pages: DataFrame, replica: DataFrame, id_col: str = "page_id", **names: str) -> DataFrame:
    """One row per id of either replica: where its records lie, their hash, and whether the replica agrees (status)."""
    ours, theirs = tree(pages, id_col=id_col, **names), tree(replica, id_col=id_col, **names)
    found = offsets(ours).join(audit(ours, theirs), NODE, "full_outer")
    return found.select(
        F.when(F.col("no_id"), F.col("node")).alias(id_col), "n_records", "offset", F.col("bytes").alias("length"), "sha256",
        F.coalesce("damage", F.lit("intact")).alias("status"),
    )
