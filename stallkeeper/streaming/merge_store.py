"""A keyed table that takes change batches and rewrites only the buckets they touch.

Rows lie in buckets of a hash of their key, each in a folder of the version that wrote it last: data/version=<v>/bucket=<b>.  A manifest
for each version names, for every bucket, the version that holds it.  A batch reads the buckets of its keys, merges them, writes
them under the next version and then its manifest, one file: readers see the whole batch or nothing of it.  A batch that is replayed writes
the same version again.  Versions that none of the newest manifests names any more are removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.features import cdc_apply
from ..sources.tables import drop_folders

_MANIFEST = "bucket int, held_by int"


class MergeStore:
    def __init__(self, spark: SparkSession, root: str, schema: str, key: str = "customer_id", buckets: int = 64, keep: int = 2):
        self.spark, self.root, self.schema, self.key, self.buckets, self.keep = spark, root, schema, key, buckets, keep

    def _bucket(self, df: DataFrame) -> DataFrame:
        return df.withColumn("bucket", F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int"))

    def _write(self, rows: DataFrame, version: int) -> None:
        self._bucket(rows).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/data/version={version}")

    def _publish(self, held: dict[int, int], version: int) -> None:
        self.spark.createDataFrame(sorted(held.items()), _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/version={version}")

    def create(self, rows: DataFrame) -> None:
        """Version 0 with all ``rows``."""
        self._write(rows, 0)
        self._publish(dict.fromkeys(range(self.buckets), 0), 0)

    def version(self) -> int:
        return self.spark.read.schema(_MANIFEST + ", version int").parquet(f"{self.root}/manifest").agg(F.max("version")).first()[0]

    def held(self, version: int) -> dict[int, int]:
        """Bucket to the version that holds its rows; one entry for each bucket."""
        return {r["bucket"]: r["held_by"] for r in self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifest/version={version}").collect()}

    def read(self, version: int | None = None, only: list[int] | None = None) -> DataFrame:
        """The table as of a version, the newest if none is named; of some buckets if asked for.  Other folders are not listed."""
        held = self.held(self.version() if version is None else version)
        chosen: dict[int, list[int]] = {}
        for bucket, at in held.items():
            if only is None or bucket in only:
                chosen.setdefault(at, []).append(bucket)
        keep = F.lit(False)
        for at, buckets in chosen.items():
            keep |= (F.col("version") == at) & F.col("bucket").isin(buckets)
        return self.spark.read.schema(f"{self.schema}, version int, bucket int").parquet(f"{self.root}/data").filter(keep).drop("version", "bucket")

    def merge(self, changes: DataFrame, version: int, order_by: str | None = None) -> list[int]:
        """Apply ``changes`` to ``version`` and publish the next one; the buckets that were rewritten."""
        touched = sorted(r["bucket"] for r in self._bucket(changes.select(self.key)).select("bucket").distinct().collect())
        if touched:
            self._write(cdc_apply(self.read(version, touched), changes, order_by), version + 1)
        self._publish(self.held(version) | dict.fromkeys(touched, version + 1), version + 1)
        self._remove_old(version + 1)
        return touched

    def _remove_old(self, newest: int) -> None:
        """Folders of versions that no kept manifest names."""
        kept = range(max(newest - self.keep + 1, 0), newest + 1)
        named = {at for v in kept for at in self.held(v).values()}
        drop_folders(self.spark, f"{self.root}/data", lambda name: int(name.removeprefix("version=")) not in named | set(kept))
        drop_folders(self.spark, f"{self.root}/manifest", lambda name: int(name.removeprefix("version=")) not in kept)
