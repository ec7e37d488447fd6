"""Snapshots that carry a hash tree, and their difference without reading what is equal.

A snapshot lies in leaves of a hash of its key.  Its tree gives every leaf a digest of its rows, whatever their order, and every node above
a digest of its FAN children.  Two snapshots are compared from the root down: only children of nodes that differ are looked at, and only
the rows of leaves that differ are read and joined.  A digest is a count and two sums of 60 bits of the rows' SHA-256.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.etl import snapshot_change_detect

FAN = 16
_TREE = "node bigint, rows bigint, digest string, level int"


def save_snapshot(df: DataFrame, path: str, key: str = "customer_id", depth: int = 2) -> None:
    """Write ``df`` in FAN**depth leaves with its tree; rows without key share a leaf."""
    spark = df.sparkSession
    leaf = F.coalesce(F.pmod(F.xxhash64(key), F.lit(FAN**depth)), F.lit(0)).cast("bigint")
    df.withColumn("leaf", leaf).hint("rebalance", "leaf").write.partitionBy("leaf").parquet(f"{path}/rows")
    whole = F.sha2(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}), 256)
    bits = lambda at: F.sum(F.conv(F.substring("h", at, 15), 16, 10).cast("decimal(38,0)")).cast("string")
    stored = spark.read.schema(df.withColumn("leaf", leaf).schema).parquet(f"{path}/rows")
    level = stored.select("leaf", whole.alias("h")).groupBy(F.col("leaf").alias("node")).agg(
        F.count("*").alias("rows"), F.concat_ws("-", bits(1), bits(16)).alias("digest"))
    for at in range(depth, -1, -1):
        level.withColumn("level", F.lit(at)).write.mode("append").partitionBy("level").parquet(f"{path}/tree")
        below = _level(spark, path, at)
        children = F.sort_array(F.collect_list(F.struct("node", "rows", "digest")))  # FAN of them at most
        level = below.groupBy(F.floor(F.col("node") / FAN).alias("node")).agg(
            F.sum("rows").alias("rows"), F.sha2(F.to_json(children), 256).alias("digest"))


def _level(spark: SparkSession, path: str, level: int) -> DataFrame:
    return spark.read.schema(_TREE).parquet(f"{path}/tree").filter(F.col("level") == level).drop("level")


def differing_leaves(spark: SparkSession, old: str, new: str, depth: int = 2) -> list[int]:
    """Numbers of the leaves whose rows are not the same in both snapshots."""
    differ: DataFrame | None = None
    found: list[int] = []
    for level in range(depth + 1):
        a, b = _level(spark, old, level), _level(spark, new, level)
        if differ is not None:
            inside = F.floor(F.col("node") / FAN).isin(found)
            a, b = a.filter(inside), b.filter(inside)
        differ = a.select("node", F.struct("rows", "digest").alias("a")).join(
            b.select("node", F.struct("rows", "digest").alias("b")), "node", "full_outer").filter(~F.col("a").eqNullSafe(F.col("b")))
        found = sorted(r["node"] for r in differ.select("node").collect())
        if not found:
            break
    return found


def read_leaves(spark: SparkSession, path: str, leaves: list[int], schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, leaf bigint").parquet(f"{path}/rows").filter(F.col("leaf").isin(leaves)).drop("leaf")


def snapshot_diff(spark: SparkSession, old: str, new: str, schema: str, depth: int = 2, **how) -> DataFrame:
    """``snapshot_change_detect`` of two stored snapshots, over the leaves that differ."""
    leaves = differing_leaves(spark, old, new, depth)
    return snapshot_change_detect(read_leaves(spark, new, leaves, schema), read_leaves(spark, old, leaves, schema), **how)
