"""Reading raw files and writing partitioned tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import stage
from .schemas import schema_of

CORRUPT = "_corrupt_record"


# ---- raw files -----------------------------------------------------------

def read_csv_raw(spark: SparkSession, path: str, header: list[str] | None = None) -> DataFrame:
    """All fields as text; rows of the wrong length fill ``_corrupt_record``.

    ``header`` names the fields of files without a header line.
    """
    names = header or spark.read.option("header", True).csv(path).columns
    fields = [StructField(n, StringType()) for n in names] + [StructField(CORRUPT, StringType())]
    reader = (
        spark.read.schema(StructType(fields)).option("header", header is None).option("quote", '"')
        .option("escape", '"').option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        # a row's length is only checked when all fields are parsed
        .option("columnPruning", False)
    )
    return reader.csv(path)


def bind_schema(raw: DataFrame, schema: StructType) -> DataFrame:
    """Declared columns taken from the file by name, never by position."""
    have = set(raw.columns)
    return raw.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])


def csv_split(spark: SparkSession, path: str, table: str, header: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, rejected): rows in the declared schema without ``ds``, and (line, reason) of all others.

    A row is rejected if it has too few or too many fields or a value that does not fit its column's type.
    The two parts read one staged table and sum to the file.
    """
    raw = stage(read_csv_raw(spark, path, header), "parsed")
    schema = StructType([f for f in schema_of("ods", table).fields if f.name != "ds"])
    have = set(raw.columns)
    misfit = [F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f"bad value in {f.name}"))
              for f in schema.fields if f.name in have and not isinstance(f.dataType, StringType)]
    reason = F.coalesce(F.when(F.col(CORRUPT).isNotNull(), F.lit("wrong number of fields")), *misfit)
    fields = F.to_json(F.struct(*[c for c in raw.columns if c != CORRUPT]))
    rejected = raw.filter(reason.isNotNull()).select(F.coalesce(CORRUPT, fields).alias("line"), reason.alias("reason"))
    return bind_schema(raw.filter(reason.isNull()), schema), rejected


def csv_ingest(spark: SparkSession, path: str, table: str, header: list[str] | None = None,
               rejects: str | None = None) -> DataFrame:
    """Good rows of a raw file; the others are written to ``rejects``.

    Without that folder a file with rejected rows stops the load.
    """
    good, rejected = csv_split(spark, path, table, header)
    if rejects is not None:
        rejected.write.mode("append").parquet(rejects)
    elif not rejected.isEmpty():
        counts = {r["reason"]: r["count"] for r in rejected.groupBy("reason").count().collect()}
        raise ValueError(f"{table}: rejected rows and no folder for them: {counts}")
    return good


def quarantine(spark: SparkSession, path: str, header: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Split a raw file into good rows and the text of malformed rows.

    The file is parsed once into a staged table that both parts read.
    """
    raw = stage(read_csv_raw(spark, path, header), "parsed")
    return raw.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), raw.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def typed_view(df: DataFrame, timestamps: list[str], dates: list[str] = ()) -> DataFrame:
    """Cast text columns; ``<column>_rejected`` marks text that is no date."""
    out = df
    for c, build in [(c, F.try_to_timestamp) for c in timestamps] + [(c, _try_date) for c in dates]:
        out = out.withColumn(f"{c}_typed", build(F.col(c))).withColumn(
            f"{c}_rejected", F.col(c).isNotNull() & F.col(f"{c}_typed").isNull())
    return out


def _try_date(c: Column) -> Column:
    return c.try_cast("date")


# ---- table writers -------------------------------------------------------

def conform(df: DataFrame, layer: str, table: str, optional: tuple[str, ...] = ()) -> DataFrame:
    """Declared columns of a published table; one that is absent must be named in ``optional``."""
    schema = schema_of(layer, table)
    missing = [f.name for f in schema.fields if f.name not in df.columns and f.name not in optional]
    if missing:
        raise ValueError(f"{layer}.{table}: no column {', '.join(missing)}")
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def overwrite_partition(df: DataFrame, path: str, ds: str) -> None:
    """Replace one ``ds`` partition; a rerun gives the same table."""
    (df.drop("ds").withColumn("ds", F.lit(ds)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("ds").parquet(path))


def append_partition(df: DataFrame, path: str, ds: str, idempotent: bool = False) -> None:
    """Add to one ``ds`` partition; ``idempotent`` replaces it instead."""
    if idempotent:
        overwrite_partition(df, path, ds)
        return
    df.drop("ds").withColumn("ds", F.lit(ds)).write.mode("append").partitionBy("ds").parquet(path)


def overwrite_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """``ds`` is text: partition discovery would make it a number."""
    flat = spark.read.parquet(path)
    if "ds" not in flat.columns or dict(flat.dtypes)["ds"] == "string":
        return flat
    fields = [StructField(f.name, StringType() if f.name == "ds" else f.dataType) for f in flat.schema.fields]
    return spark.read.schema(StructType(fields)).parquet(path)


def within_retention(days: int, as_of: str) -> Column:
    """Partition filter: text order equals date order for yyyyMMdd."""
    cutoff = F.date_format(F.date_sub(F.lit(as_of).cast("date"), days), "yyyyMMdd")
    return F.col("ds") >= cutoff


def retention_report(df: DataFrame, days: int, as_of: str) -> DataFrame:
    return df.groupBy("ds").agg(F.count("*").alias("rows")).select(
        "ds", "rows", F.when(within_retention(days, as_of), "kept").otherwise("dropped").alias("action"))


def apply_retention(spark: SparkSession, path: str, days: int, as_of: str) -> list[str]:
    """Drop the expired ``ds`` folders of the table at ``path``; kept partitions are neither read nor written."""
    cutoff = (date.fromisoformat(as_of) - timedelta(days=days)).strftime("%Y%m%d")
    return [name[3:] for name in drop_folders(spark, path, lambda name: name.startswith("ds=") and name[3:] < cutoff)]


def drop_folders(spark: SparkSession, path: str, expired: Callable[[str], bool]) -> list[str]:
    """Remove the folders directly under ``path`` whose names are ``expired``; those of the writers (``_...``) stay."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [x.getPath() for x in files.listStatus(folder) if x.isDirectory()]
    gone = [p for p in found if not p.getName().startswith("_") and expired(p.getName())]
    for p in gone:
        files.delete(p, True)
    return sorted(p.getName() for p in gone)


EVENT = "run string, job_name string, event string, at timestamp, records bigint, error string"


def append_event(spark: SparkSession, folder: str, event: dict) -> None:
    """Add one event as a small JSON file, which appears as a whole; ``EVENT`` is the schema of the folder."""
    jvm = spark._jvm.org.apache.hadoop.fs
    name = uuid.uuid4().hex
    hidden, shown = jvm.Path(f"{folder}/_{name}"), jvm.Path(f"{folder}/{name}.json")
    files = shown.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(hidden)
    out.write(bytearray(json.dumps(event | {"at": event["at"].isoformat(timespec="microseconds")}).encode()))
    out.close()
    files.rename(hidden, shown)


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.lit(name).alias("table_name"), F.count("*").alias("record_count")) for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def log_job(spark: SparkSession, path: str, ds: str, job: str, kind: str, start: datetime, end: datetime,
            written: DataFrame | None, error: str | None = None) -> DataFrame:
    """Append one run to the job log; records are counted in the written partition."""
    row = [(job, kind, start, end, "FAILED" if error else "SUCCESS", error)]
    entry = spark.createDataFrame(
        row, "job_name string, job_type string, start_time timestamp, end_time timestamp, status string, error_message string")
    count = written.filter(F.col("ds") == ds).agg(F.count("*")).scalar() if written is not None else F.lit(0)
    entry = entry.withColumn("records_processed", count.cast("bigint"))
    append_partition(entry, path, ds)
    return read_table(spark, path)
