"""How work is dealt: what a query does must not come down to one task or to rounds that grow with its input."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tracelode.operators import filenames, matching
from tracelode.plans import fixtures, registry
from tracelode.streaming import jobs

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("made", [lambda s: registry.QUERIES["parse_root_cause"](s, SMALL), lambda s: filenames.accepted(fixtures.files(s, SMALL))])
def test_texts_are_made_and_filtered_behind_the_exchange(spark, made):
    """A table of one row group is one task of the scan; no rule may run in it."""
    plan = made(spark)._jdf.queryExecution().optimizedPlan().toString()
    above, scan = plan.split("RepartitionByExpression")
    assert "regexp" in above and "regexp" not in scan


def test_a_report_is_made_once(spark):
    """The gate reads it several times, and labels are looked up in one step, not once for each column."""
    plan = registry.QUERIES["parse_root_cause"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Software version : ") == 1 and plan.count("array_position") == 1


def test_prefixes_of_many_files_are_sliced(spark, monkeypatch):
    named = filenames.accepted(fixtures.files(spark, SMALL))
    sides = [named.where(F.col("kind") == kind) for kind in ("text", "image")]
    plain = matching.match_exclusive(*sides, sliced=False)
    asked = []
    monkeypatch.setattr(matching, "busy", lambda rows, most, key: asked.append(most) or True)
    sliced = matching.match_exclusive(*sides)
    assert asked == [matching.MOST_FILES] and matching.MOST_FILES <= 1_000_000
    assert sliced.exceptAll(plain).count() == 0 and plain.exceptAll(sliced).count() == 0


def test_a_stream_of_many_files_is_few_batches(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(100).repartition(25).write.parquet(source)
    schema = spark.range(1).schema
    for options, batches in (({"bytes_per_batch": registry.BATCH}, 1), ({"files_per_batch": 5}, 5)):
        out = f"{target}{batches}"
        jobs.run_once(jobs.read_logs(spark, source, schema, **options), out, f"{out}-state")
        assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == list(range(100))
        assert len(list((tmp_path / f"out{batches}-state" / "commits").glob("[0-9]*"))) == batches


@pytest.mark.parametrize("days", [1, 2, 8, 9, 49, 3000])
def test_runs_of_a_history_are_whole_days_and_few(days):
    first = date(2024, 1, 1)
    cuts = registry.run_cuts(first, first + timedelta(days=days - 1))
    start = datetime(2024, 1, 1)
    assert (cuts[0], cuts[-1]) == (start, start + timedelta(days=days)) and len(cuts) - 1 <= registry.MOST_RUNS
    assert all(a < b and b == datetime.combine(b.date(), datetime.min.time()) for a, b in zip(cuts, cuts[1:], strict=False))
