"""Layer tables in ``ds`` folders, and runs that are published by one switch.

A declared table with a ``ds`` column lies in one folder for each of its values, so a date in a filter or a joined date table
decides which folders are listed.  ``RunStore`` keeps every run of a job chain in folders of its own; readers see the rows that the
newest manifest names, and a run becomes visible, with all its tables, when its manifest is written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..session import parts_for
from .schemas import LAYERS, schema_of
from .tables import bind_schema, conform

_MANIFEST = "layer string, table_name string, ds string, run string"


def by_day(layer: str, table: str) -> bool:
    return "ds" in schema_of(layer, table).fieldNames()


def create_layers(spark: SparkSession, root: str) -> list[tuple[str, str, str]]:
    """Create every declared table empty under ``root``; returns (layer, table, path)."""
    made = []
    for layer, tables in LAYERS.items():
        for table in tables:
            path = f"{root}/{layer}/{table}"
            _write(spark.createDataFrame([], schema_of(layer, table)), path, by_day(layer, table))
            made.append((layer, table, path))
    return made


def load_layer(df: DataFrame, root: str, layer: str, table: str, rows: int = 0, key: str | None = None,
               shape: Callable[[DataFrame], DataFrame] = lambda moved: moved) -> int:
    """Load declared columns by name and return the number of rows, counted while they are written.

    A table with ``ds`` has the folders of the loaded days replaced; a day with most of the rows is written by several tasks.  ``rows``, how many
    there are at most, and a ``key`` deal them in ranges of days and keys, a million to a task, so that the writer's sort by day stays small.
    Rows travel as they are given; ``shape`` and the casts to the declared types are applied where they are written.
    """
    seen = Observation()
    days = by_day(layer, table)
    if days and key:
        df = df.repartitionByRange(parts_for(df.sparkSession, rows), "ds", key)
    elif days and "ds" in df.columns:
        df = df.hint("rebalance", "ds")
    _write(bind_schema(shape(df), schema_of(layer, table)), f"{root}/{layer}/{table}", days, seen)
    return seen.get["rows"]


def read_layer(spark: SparkSession, root: str, layer: str, table: str) -> DataFrame:
    """A layer table in its declared schema; ``ds`` stays text."""
    return spark.read.schema(schema_of(layer, table)).parquet(f"{root}/{layer}/{table}")


def _write(df: DataFrame, path: str, days: bool, rows: Observation | None = None, *metrics: Column) -> None:
    if rows is not None:
        df = df.observe(rows, F.count(F.lit(1)).alias("rows"), *metrics)
    writer = df.write.mode("overwrite")
    if days:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy("ds")
    writer.parquet(path)


class RunStore:
    """Tables of a job chain under ``root``: <layer>/<table>/run=<run>[/ds=<day>], and the manifests that publish them."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def write(self, df: DataFrame, layer: str, table: str, run: str, *metrics: Column) -> dict:
        """Write one table of a run and return its row count with the other metrics, all observed while writing."""
        seen = Observation()
        out = conform(df, layer, table)
        _write(out, f"{self.root}/{layer}/{table}/run={run}", by_day(layer, table), seen, *metrics)
        return seen.get

    def of_run(self, layer: str, table: str, run: str) -> DataFrame:
        """What one run wrote, published or not."""
        return self.spark.read.schema(schema_of(layer, table)).parquet(f"{self.root}/{layer}/{table}/run={run}")

    def manifest(self) -> dict[tuple[str, str, str | None], str]:
        """(layer, table, day) to the run that is to be read; a row for each published day of a table."""
        versions = self._versions()
        if versions is None:
            return {}
        newest = versions.filter(F.col("version") == versions.agg(F.max("version")).scalar())
        return {(r["layer"], r["table_name"], r["ds"]): r["run"] for r in newest.collect()}

    def publish(self, run: str, parts: list[tuple[str, str, str | None]]) -> None:
        """Make the (layer, table, day) parts of a run the ones that are read, all at once; other days stay as they are."""
        rows = self.manifest() | {p: run for p in parts}
        versions = self._versions()
        number = 0 if versions is None else versions.agg(F.max("version")).first()[0] + 1
        # one file, so the version is there as a whole or not at all; a second writer of the same version fails
        self.spark.createDataFrame([(*k, v) for k, v in sorted(rows.items(), key=str)], _MANIFEST).coalesce(1).write.parquet(
            f"{self.root}/_published/version={number}")

    def read(self, layer: str, table: str) -> DataFrame:
        """The published rows of a table; the scan lists the folders of their days and runs only."""
        chosen = [(ds, run) for (at, name, ds), run in self.manifest().items() if (at, name) == (layer, table)]
        schema = schema_of(layer, table)
        if not chosen:
            return self.spark.createDataFrame([], schema)
        whole = self.spark.read.schema(schema.add("run", "string")).parquet(f"{self.root}/{layer}/{table}")
        keep = F.lit(False)
        for ds, run in chosen:
            keep |= (F.col("run") == run) & (F.col("ds") == ds if ds is not None else F.lit(True))
        return whole.filter(keep).drop("run")

    def _versions(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(_MANIFEST + ", version int").parquet(f"{self.root}/_published")
        except AnalysisException:
            return None
