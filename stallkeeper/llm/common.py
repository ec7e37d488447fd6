"""Helpers shared by the operators: table reading, checked broadcasts, connected components."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import stage

#: Rows an explicitly broadcast side may have; each has at most a few hundred bytes.
BROADCAST_ROWS = 1_000_000

BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    archive = os.path.join(tempfile.mkdtemp(), "stallkeeper.zip")  # the driver serves it to the executors
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, root))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def bounded_batches(spark: SparkSession) -> None:
    """Rows go to the Python workers by 1,000, unless the session says how many.

    Spark's 10,000 rows of whole texts are held several times over, by the executor outside its heap and by each of its workers.
    """
    if spark.conf.get(BATCH_KEY, None) is None:
        spark.conf.set(BATCH_KEY, "1000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, a staged table, with a broadcast hint if it is counted to be small.

    Above the limit the join stays a shuffled one with the same rows.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def fold_ascii(text: Column) -> Column:
    """A-Z to a-z, all other characters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component) for all ids in ``edges`` (a, b); component is the smallest id reachable.

    Alternating large-star and small-star rounds.  Each round links nodes to the smallest
    neighbour through one grouped minimum and one join, so no neighbourhood is ever gathered,
    and its edges are staged in the shared folder.  Ends when a round changes nothing.
    """
    def links(df: DataFrame) -> DataFrame:
        return df.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def star(cur: DataFrame, large: bool) -> DataFrame:
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both if large else cur  # small star looks at the smaller neighbours only
        low = near.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("low", "a"))
        joined = near.join(low, "a")
        if large:
            return links(joined.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")))
        return links(joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            low.select("a", F.col("low").alias("b"))))

    def state(df: DataFrame):
        row = df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(row)

    cur = stage(links(edges), "edges")
    seen = state(cur)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        cur = stage(star(star(cur, True), False), "edges")
        now = state(cur)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return cur.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        cur.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def slices(texts: list[str] | list[int], chars: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``chars`` characters each; of texts or their lengths."""
    start = held = 0
    for i, t in enumerate(texts):
        held += t if isinstance(t, int) else len(t)
        if held >= chars:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def cut_out(df: DataFrame, spans: str, mark: str) -> DataFrame:
    """``text`` with ``mark`` for each of its spans (start, end), in order of their starts; null spans change nothing.

    Spans that overlap the one before share its mark.  A column n_chars follows the text.
    """
    text, cut = F.col("text"), F.col(spans).isNotNull()
    step = lambda acc, s: F.struct(
        F.greatest(acc["pos"], s["end"]).alias("pos"),
        F.when(s["start"] >= acc["pos"], F.concat(acc["out"], F.substring(text, acc["pos"] + 1, s["start"] - acc["pos"]), F.lit(mark))).otherwise(
            acc["out"]).alias("out"))
    folded = F.aggregate(spans, F.struct(F.lit(0).alias("pos"), F.lit("").alias("out")), step,
                         lambda acc: F.concat(acc["out"], F.substring(text, acc["pos"] + 1, F.length(text))))
    out = df.withColumn("text", F.when(cut, folded).otherwise(text))
    if "n_chars" in df.columns:
        out = out.withColumn("n_chars", F.when(cut, F.length("text").cast(df.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out
