"""Raw files, partitioned writes and retention."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stallkeeper.sources import tables


def write_lines(spark, path, lines):
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)


def test_columns_bind_by_name_not_position(spark, folder):
    path = folder()
    write_lines(spark, path, [
        "supplier_id,supplier_name,contact_name,email,phone,address,city,country,rating,established_year",
        "SUP001,Acme,Jo,jo@acme.com,+1-555-1001,1 Main St,Austin,USA,4.8,2015"])
    row = tables.csv_ingest(spark, path, "suppliers").first()
    assert (row["country"], row["city"], row["product_category"], row["rating"]) == ("USA", "Austin", None, 4.8)


def test_quoted_comma_stays_one_field(spark, folder):
    path = folder()
    head = "event_id,session_id,user_id,event_type,event_timestamp,page_url,element_id,element_type,event_data"
    write_lines(spark, path, [head, 'EV7,SN3,UR9,wish_add,2022-07-03 08:12:00,/list,wl,button,"items:A1,B2"'])
    assert tables.csv_ingest(spark, path, "user_events").first()["event_data"] == "items:A1,B2"


def test_malformed_rows_are_set_aside(spark, folder):
    path = folder()
    head = "event_id,session_id,user_id,event_type,event_timestamp,page_url,element_id,element_type,event_data"
    write_lines(spark, path, [head, "E1,S,U,click,t,/p,e,k,a", "E2,S,U,click,t,/p,e,k,a,b", "E3,S,U,click", "E4,S,U,view,t,/p,,k,"])
    good, bad = tables.quarantine(spark, path)
    assert {r["event_id"] for r in good.collect()} == {"E1", "E4"}
    assert {r[0].split(",")[0] for r in bad.collect()} == {"E2", "E3"}
    with pytest.raises(ValueError, match="wrong number of fields.*2"):
        tables.csv_ingest(spark, path, "user_events")
    rejects = folder()
    assert tables.csv_ingest(spark, path, "user_events", rejects=rejects).count() == 2
    assert spark.read.parquet(rejects).count() == 2


def test_bad_number_is_rejected(spark, folder):
    path = folder()
    write_lines(spark, path, ["product_id,price,cost", "P1,12.5,x", "P2,3,"])
    good, rejected = tables.csv_split(spark, path, "products")
    assert [(r["product_id"], r["price"], r["cost"], r["brand"]) for r in good.collect()] == [("P2", 3.0, None, None)]
    assert [(r["reason"], '"cost":"x"' in r["line"]) for r in rejected.collect()] == [("bad value in cost", True)]


def test_partition_overwrite_append_and_pruning(spark, folder):
    path = folder()
    df = spark.createDataFrame([(1, "20240114"), (2, "20240115")], "id long, ds string")
    for ds in ("20240114", "20240115"):
        tables.overwrite_partition(df.filter(F.col("ds") == ds), path, ds)
    tables.overwrite_partition(spark.createDataFrame([(7,)], "id long"), path, "20240115")
    read = tables.read_table(spark, path)
    assert read.schema["ds"].dataType.simpleString() == "string"
    assert {tuple(r) for r in read.collect()} == {(1, "20240114"), (7, "20240115")}
    tables.append_partition(spark.createDataFrame([(7,)], "id long"), path, "20240115")
    assert tables.read_table(spark, path).filter("ds='20240115'").count() == 2
    tables.append_partition(spark.createDataFrame([(9,)], "id long"), path, "20240115", idempotent=True)
    assert [r["id"] for r in tables.read_table(spark, path).filter("ds='20240115'").collect()] == [9]
    plan = tables.read_table(spark, path).filter(F.col("ds") == "20240115")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ds" in plan


def test_retention_keeps_the_last_days(spark, folder):
    df = spark.createDataFrame([(1, "20240101"), (2, "20240114"), (3, "20240115")], "id long, ds string")
    target = folder()
    df.write.partitionBy("ds").parquet(target)
    assert tables.apply_retention(spark, target, 30, "2024-02-14") == ["20240101", "20240114"]
    assert {r["id"] for r in tables.read_table(spark, target).collect()} == {3}
    report = {r["ds"]: r["action"] for r in tables.retention_report(df, 30, "2024-02-14").collect()}
    assert report == {"20240101": "dropped", "20240114": "dropped", "20240115": "kept"}


def test_typed_view_counts_rejects(spark):
    df = spark.createDataFrame([("2024-01-15 10:30:00", "2024-01-15"), ("soon", "2024-13-01"), (None, None)], "a string, b string")
    rows = tables.typed_view(df, ["a"], ["b"]).collect()
    assert [r["a_rejected"] for r in rows] == [False, True, False] and [r["b_rejected"] for r in rows] == [False, True, False]
    assert rows[0]["a_typed"] == datetime(2024, 1, 15, 10, 30)


def test_job_log_appends(spark, folder):
    path, data = folder(), spark.createDataFrame([(1, "20240115"), (2, "20240115")], "id long, ds string")
    t = datetime(2024, 1, 15, 2)
    tables.log_job(spark, path, "20240115", "a", "FACT_TABLE", t, t, data)
    log = tables.log_job(spark, path, "20240115", "b", "FACT_TABLE", t, t, None, error="boom")
    got = {r["job_name"]: (r["status"], r["records_processed"], r["error_message"]) for r in log.collect()}
    assert got == {"a": ("SUCCESS", 2, None), "b": ("FAILED", 0, "boom")}
