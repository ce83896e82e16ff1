"""Audits by groups against row by row, and counts of a load against counts of its steps."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.test_streaming import messages
from tracelode.functions import dose
from tracelode.operators import audit, state
from tracelode.plans import pipelines
from tracelode.sources import logs as sources

WINDOW = datetime(2026, 5, 1), datetime(2026, 5, 1, 6)


def plainly(rows):
    return sorted(map(str, rows.collect()))


def both(spark, fault):
    """Messages of two days with some repeats and null keys, and a result that lacks or doubles what `fault` says."""
    rows = messages(spark, 900).withColumn("er_line", F.expr("case when er_index % 17 = 3 then null else er_line end"))
    rows = rows.withColumn("code_occur_time", F.expr("code_occur_time + make_dt_interval(er_index % 2, 0, 0, 0)"))
    rows = rows.union(rows.where("er_index % 40 = 0"))
    parsed = dose.parse_dose_warnings(rows.where(F.col("code").isin(*dose.TARGET_CODES)))
    there = {
        "none": parsed,
        "lost": parsed.where("er_index not in (30, 33, 301)"),
        "doubled": parsed.union(parsed.where("er_index = 36")),
        "changed": parsed.withColumn("er_date", F.expr("case when er_index = 39 then 1 else er_date end")),
        "swapped": parsed.withColumn("er_index", F.expr("case er_index when 60 then 66 when 66 then 60 else er_index end")),
        "all": parsed.limit(0),
    }
    return rows, there[fault]


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("fault", ["none", "lost", "doubled", "changed", "swapped", "all"])
def test_groups_report_what_rows_report(spark, fault, null_safe):
    rows, there = both(spark, fault)
    window = datetime(2026, 5, 1), datetime(2026, 5, 3)
    want = plainly(audit.missing_from_parsed(rows, there, *window, null_safe=null_safe))
    assert plainly(audit.missing_by_groups(rows, there, *window, null_safe=null_safe)) == want
    assert (fault in ("none", "doubled")) == (len(want) == 0) or not null_safe


def test_only_groups_that_differ_are_named(spark):
    rows, there = both(spark, "lost")
    known = dose.parse_dose_warnings(rows.where(F.col("code").isin(*dose.TARGET_CODES)))
    assert audit.differing_groups(known, known.repartition(7)).count() == 0
    named = {(str(r.day), r.machine) for r in audit.differing_groups(known, there).collect()}
    lost = known.where("er_index in (30, 33, 301)").select(F.to_date("code_occur_time").alias("d"), "eq_name").collect()
    assert named == {(str(r.d), r.eq_name) for r in lost} and len(named) < 5


@pytest.mark.parametrize("sliced", [True, False])
def test_a_load_tells_what_it_saw(spark, tmp_path, sliced):
    rows = messages(spark)
    rows = rows.union(rows.where("er_index % 10 < 3"))
    rows = rows.withColumn("contents", F.expr("case when er_index = 9 then 'action_handle=99999999999999999999 de_err=123456.5 wafer(7)' else contents end"))
    scanned = sources.scan_dose_logs(rows, *WINDOW)
    kept = state.drop_test_shots(dose.parse_dose_warnings(scanned), sliced=False)
    table = pipelines.dose_table(rows, *WINDOW, sliced=False)
    counts = pipelines.dose_load(rows, str(tmp_path / "table"), *WINDOW, sliced=sliced)
    assert counts == {"fetched": scanned.count(), "parsed": kept.count(), "inserted": table.count(), "nulled": 2}
    stored = spark.read.parquet(str(tmp_path / "table"))
    assert plainly(stored.select(*table.columns)) == plainly(table)
    none = pipelines.dose_load(rows, str(tmp_path / "none"), datetime(2030, 1, 1), datetime(2030, 1, 2), sliced=sliced)
    assert none == {"fetched": 0, "parsed": 0, "inserted": 0, "nulled": 0}
