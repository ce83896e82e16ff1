"""Loads into a database and into a table with statistics of its days."""

from __future__ import annotations

import os
import subprocess
import sys
import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from tracelode.sources import database
from tracelode.sources.scratch import scratch_dir
from tracelode.sources.sinks import append_days_to_table, rows_by_statistics

#: Null, empty, and what a statement would have to quote.
TEXTS = """case id % 3 when 1 then '' when 2 then concat("o'n\\n", '"e"; --', id) end as `te xt`"""


def new_url():
    return f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true"


def some(spark, n=1000):
    return spark.range(n, numPartitions=4).selectExpr("id", TEXTS, "id / 7 as x")


def back(spark, url, table):
    return spark.read.format("jdbc").option("url", url).option("dbtable", database.quoted(table)).load()


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_a_load_counts_once(spark):
    url, rows = new_url(), some(spark)
    assert [database.load_table(rows, url, "er_raw", i) for i in ("one", "one", "two")] == [1000, 0, 1000]
    assert same(back(spark, url, "er_raw"), rows.union(rows))
    assert database.load_table(rows.limit(0), url, "none", "three") == 0 and back(spark, url, "none").count() == 0
    for bad in ("a b", "", "x'"):
        with pytest.raises(ValueError):
            database.load_table(rows, url, "er_raw", bad)
    with pytest.raises(ValueError):
        database.load_table(rows.withColumn("Load_Row", F.lit(1)), url, "er_raw", "four")


def test_rows_that_came_twice_are_taken_once(spark):
    url, rows = new_url(), some(spark)
    database.load_table(rows, url, "er_raw", "one")
    kept = database.numbered(rows)
    database.stage(kept, url, "stage_two")
    again = kept.where("id < 300").withColumn(database.COPY, F.expr("uuid()"))
    again.write.format("jdbc").option("url", url).option("dbtable", '"stage_two"').mode("append").save()
    assert back(spark, url, "stage_two").count() == 1300
    assert database.swap(spark, url, "stage_two", "er_raw", rows.columns, "two", 1000) == 1000
    assert same(back(spark, url, "er_raw"), rows.union(rows))


def test_a_load_that_dies_leaves_nothing_and_is_repeated(spark, monkeypatch):
    url, rows = new_url(), some(spark)
    # A task's rows are missing at the swap: nothing changes.
    whole = database.stage
    monkeypatch.setattr(database, "stage", lambda kept, *a, **o: whole(kept.where("id <> 7"), *a, **o))
    with pytest.raises(RuntimeError):
        database.load_table(rows, url, "er_raw", "one")
    assert back(spark, url, "er_raw").count() == 0 and back(spark, url, database.LOADS).count() == 0
    monkeypatch.setattr(database, "stage", whole)
    # Dead between staging and swap.
    taken = database.swap
    monkeypatch.setattr(database, "swap", lambda *a, **o: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        database.load_table(rows, url, "er_raw", "one")
    monkeypatch.setattr(database, "swap", taken)
    assert database.load_table(rows, url, "er_raw", "one") == 1000
    assert same(back(spark, url, "er_raw"), rows)


RETRIED = """
import os, sys
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from tracelode.sources import database
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate()
url = "jdbc:derby:memory:t;create=true"
rows = spark.range(2000, numPartitions=2).select("id")
with database.transaction(spark, url) as held:
    database.execute(held, 'create table "finished_loads" (load_id varchar(64) not null primary key, n_rows bigint)')
    database.execute(held, 'create table "t" ("id" bigint)')
kept = database.numbered(rows)
def dies(batches):
    for k, batch in enumerate(batches):
        if k == 3 and TaskContext.get().attemptNumber() == 0:
            raise OSError("lost")
        yield batch
spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
database.stage(kept.mapInArrow(dies, kept.schema), url, "stage_a", batchsize=10, isolationLevel="NONE")
with database.transaction(spark, url) as held:
    print("STAGED", database.number(held, 'select count(*) from "stage_a"'))
database.swap(spark, url, "stage_a", "t", ["id"], "a", 2000)
with database.transaction(spark, url) as held:
    print("TAKEN", database.number(held, 'select count(*) from "t"'), database.number(held, 'select count(distinct "id") from "t"'))
"""


def test_a_task_that_is_run_again(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run(
        [sys.executable, "-c", RETRIED], capture_output=True, text=True, timeout=300, cwd=tmp_path, env={**os.environ, "PYTHONPATH": root}
    )
    told = dict(line.split(" ", 1) for line in done.stdout.splitlines() if line.startswith(("STAGED", "TAKEN")))
    assert int(told["STAGED"]) > 2000, done.stderr[-3000:]
    assert told["TAKEN"] == "2000 2000"


def test_only_the_days_of_a_load_are_analysed(spark):
    name = f"days_{uuid.uuid4().hex}"
    spark.sql(f"create table {name} (x string, id long, event_date date) using parquet partitioned by (event_date) location '{scratch_dir(spark, name)}'")
    day = lambda k: date(2024, 1, k)
    rows = spark.range(90).select("id", F.lit("x").alias("x"), F.expr("date'2024-01-01' + cast(id % 3 as int)").alias("event_date"))
    assert append_days_to_table(rows, name) == [day(1), day(2), day(3)]
    # Beside the load, another program's rows: their day's statistics stay as they are.
    rows.where("id % 3 = 0").select("x", "id", "event_date").write.mode("append").insertInto(name)
    more = rows.where("id % 3 = 1").withColumn("event_date", F.when(F.col("id") > 30, F.col("event_date")))
    assert append_days_to_table(more, name) == [day(2)]
    assert rows_by_statistics(spark, name, "event_date", [day(1), day(2), day(3)]) == {day(1): 30, day(2): 50, day(3): 30}
    assert append_days_to_table(rows.limit(0), name) == []
    spark.conf.set("spark.sql.cbo.enabled", "true")
    try:
        plan = spark.table(name).where("event_date = date'2024-01-02'")._jdf.queryExecution().optimizedPlan()
        assert 30 <= plan.stats().rowCount().get() <= 60
    finally:
        spark.conf.unset("spark.sql.cbo.enabled")
        spark.sql(f"drop table {name}")
    with pytest.raises(ValueError):
        append_days_to_table(rows, "no_such_table")
