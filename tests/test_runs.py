"""Work that goes on from run to run: ledger tables by buckets, the exclusive match from what was left."""

from __future__ import annotations

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tracelode.operators import ledger
from tracelode.operators.carried import nothing_free, match_run
from tracelode.operators.ledger_table import LedgerTable
from tracelode.operators.matching import match_exclusive
from tracelode.plans.pipelines import matches_by_runs

ROW = (
    "source_file string, prefix string, image_ts timestamp_ntz, matched_text_file string, matched_text_ts timestamp_ntz, "
    "matched_diff_seconds long, output_remote_file string"
)
LEDGER = f"{ROW}, created_at timestamp_ntz, updated_at timestamp_ntz"
THEN, LATER = datetime(2024, 1, 1), datetime(2024, 2, 1)


def entry(i, text="old", output=None):
    return (f"f{i}", "p", THEN, text, THEN, i, output)


def files_of(path) -> dict[int, set]:
    """Data files of each bucket."""
    out: dict[int, set] = {}
    for folder, _, names in os.walk(path):
        if "bucket=" in folder:
            out[int(folder.rsplit("=", 1)[1])] = {(n, os.stat(f"{folder}/{n}").st_mtime_ns) for n in names if n.endswith(".parquet")}
    return out


def plainly(rows):
    return sorted(map(tuple, rows.collect()), key=str)


@pytest.fixture
def book(spark, tmp_path):
    old = spark.createDataFrame([(*entry(i), THEN, None) for i in range(200)] + [(None, *entry(0)[1:], THEN, None)], LEDGER)
    return old.where("source_file is not null"), LedgerTable.create(old, str(tmp_path / "book"), 16)


OPERATIONS = {
    "upsert": (ledger.upsert, [3, 5, 900], True),
    "insert_if_absent": (ledger.insert_if_absent, [3, 901], True),
    "update_match": (ledger.update_match, [7, 902], True),
    "finalize": (ledger.finalize, [9], True),
    "apply_run": (ledger.apply_run, [11, 903], True),
    "remove": (ledger.remove, [13, 14], False),
}


@pytest.mark.parametrize("name", OPERATIONS)
def test_a_run_writes_its_own_buckets_alone(spark, book, name):
    rows, table = book
    operation, keys, timed = OPERATIONS[name]
    run = spark.createDataFrame([entry(i, "new", "out") for i in keys] + [(None, *entry(1)[1:])], ROW)
    now = [F.lit(LATER).cast("timestamp_ntz")] if timed else []
    before = files_of(table.path)
    touched = table.apply(operation, run, *now)
    after = files_of(table.path)
    changed = {b for b in before if before[b] != after[b]}
    assert changed == set(touched) and 0 < len(touched) <= len(keys) and set(after) == set(range(16))
    want = operation(rows, run.where("source_file is not null"), *now)
    assert plainly(table.read()) == plainly(want.select(*table.columns))
    assert plainly(LedgerTable(spark, table.path).read()) == plainly(table.read())


def test_the_plan_reads_touched_buckets(book):
    _, table = book
    read = table.in_buckets([2, 5])
    assert {f.split("bucket=")[1].split("/")[0] for f in (r.f for r in read.select(F.input_file_name().alias("f")).distinct().collect())} <= {"2", "5"}
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1].split("]")[0]


def test_buckets_whose_rows_all_go(spark, book):
    rows, table = book
    everything = rows.select("source_file")
    assert len(table.apply(ledger.remove, everything)) == 16
    assert table.read().count() == 0 and len(files_of(table.path)) == 16
    table.apply(ledger.upsert, spark.createDataFrame([entry(1)], ROW), F.lit(LATER).cast("timestamp_ntz"))
    assert [r.source_file for r in table.read().collect()] == ["f1"]


def test_runs_without_rows_and_tables_without(spark, tmp_path, book):
    _, table = book
    before = files_of(table.path)
    assert table.apply(ledger.upsert, spark.createDataFrame([], ROW), F.lit(LATER).cast("timestamp_ntz")) == []
    assert files_of(table.path) == before
    empty = LedgerTable.create(spark.createDataFrame([], LEDGER), str(tmp_path / "empty"), 4)
    assert empty.read().count() == 0 and empty.buckets == 4
    with pytest.raises(ValueError, match="buckets"):
        LedgerTable.create(spark.createDataFrame([], LEDGER), str(tmp_path / "none"), 0)


# The exclusive match

FILE = "file_id long, kind string, prefix string, path string, file_ts timestamp_ntz"


def some_files(spark, seed, n=400, span=7200):
    some = random.Random(seed)
    rows = []
    for i in range(n):
        kind, prefix = some.choice(["text", "image"]), some.choice("pq")
        rows.append((i, kind, prefix, f"/{prefix}/{some.randrange(9)}.{kind}", THEN + timedelta(seconds=some.randrange(span))))
    return spark.createDataFrame(rows, FILE)


def cuts_at(*seconds):
    return [THEN + timedelta(seconds=s) for s in seconds]


@pytest.mark.parametrize(
    "cuts", [(0, 7200), (0, 3600, 7200), (0, 60, 120, 200, 210, 900, 3000, 3290, 3300, 7200), (-900, -100, 5000, 6000, 9000)]
)
def test_runs_give_what_one_pass_gives(spark, tmp_path, cuts):
    files = some_files(spark, len(cuts))
    want = match_exclusive(files.where("kind = 'text'"), files.where("kind = 'image'"), sliced=False)
    got = matches_by_runs(files, cuts_at(*cuts), str(tmp_path / "runs"))
    assert plainly(got.select(*want.columns)) == plainly(want)
    assert want.where("image_id is not null").count() > 20


def test_sliced_runs(spark):
    files = some_files(spark, 77)
    texts, images = files.where("kind = 'text'"), files.where("kind = 'image'")
    free, found = nothing_free(spark), None
    for since, until in zip(cuts_at(0, 2000, 4500), cuts_at(2000, 4500, 7200), strict=True):
        pairs, free = match_run(texts, images, free, since, until, sliced=True)
        found = pairs if found is None else found.union(pairs)
    assert plainly(found) == plainly(match_exclusive(texts, images, sliced=False))


def test_what_is_handed_on_is_bounded_by_the_reach(spark):
    files = some_files(spark, 5, n=900)
    _, free = match_run(files.where("kind = 'text'"), files.where("kind = 'image'"), nothing_free(spark), *cuts_at(0, 5000))
    left = free.collect()
    assert left and all(r.file_ts >= THEN + timedelta(seconds=4700) for r in left)
    assert sorted(r["rank"] for r in left if r.prefix == "p") == list(range(1, 1 + sum(r.prefix == "p" for r in left)))


def test_a_stored_run_is_not_done_again(spark, tmp_path):
    files, folder = some_files(spark, 6), str(tmp_path / "runs")
    want = plainly(matches_by_runs(files, cuts_at(0, 3000, 7200), folder))
    # Without the first stretch's files the same comes out, as only what it left is read.
    later = files.where(F.col("file_ts") >= F.lit(THEN + timedelta(seconds=3000)))
    assert plainly(matches_by_runs(later, cuts_at(0, 3000, 7200), folder)) == want
    assert matches_by_runs(files.limit(0), cuts_at(0, 10), str(tmp_path / "none")).count() == 0
