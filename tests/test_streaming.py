"""Streams give what batches give, however the input is cut."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.test_rules import REPORT
from tracelode.functions import dose, root_cause
from tracelode.operators import ledger, state
from tracelode.plans import pipelines
from tracelode.sources import logs as sources
from tracelode.streaming import ingest, jobs

LOGS = (
    "er_date int, er_index int, er_line string, eq_name string, code string, code_occur_time timestamp_ntz, belong string, "
    "type string, title string, contents string"
)


def messages(spark, n=400):
    """Messages in order of time, with handles that sometimes jump and wafers that sometimes show."""
    return spark.range(n).selectExpr(
        "20260501 as er_date",
        "cast(id as int) as er_index",
        "'L1' as er_line",
        "case when id % 13 = 0 then null else 'E' || id % 3 end as eq_name",
        "case id % 3 when 0 then 'DW-3411' when 1 then 'LO-0061' else 'XX-1' end as code",
        "timestamp_ntz'2026-05-01 00:00:00' + make_dt_interval(0, 0, 0, id * 60) as code_occur_time",
        "'b' as belong",
        "'t' as type",
        "'x' as title",
        "case when id % 3 = 0 then 'exposure_handle=' || (id * 7 + (id div 50) * 1500) "
        "when id % 5 = 0 then 'lot(' || id % 20 || ') wafer(' || id % 7 || ')' end as contents",
    )


def streamed(spark, tmp_path, rows, seed, pieces, **options):
    """Rows of the stream over files that come as the `pieces`, one for each micro-batch, and are then closed."""
    source = str(tmp_path / "in")
    seed.write.mode("ignore").parquet(str(tmp_path / "seed"))
    for piece in [*pieces, jobs.closing(spark, rows.schema, datetime(2026, 6, 1))]:
        piece.coalesce(1).write.mode("append").parquet(source)
        if piece is pieces[-1] or piece.count() == 1:
            stream = jobs.dose_warnings(jobs.read_logs(spark, source, rows.schema), spark.read.parquet(str(tmp_path / "seed")), **options)
            jobs.run_once(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    return spark.read.parquet(str(tmp_path / "out")).select(*dose.PARSED_COLUMNS)


SEED = [("E0", 77, None), ("E1", None, 88)]


@pytest.mark.parametrize("order", [None, "mixed", "falling"])
def test_dose_warnings(spark, tmp_path, order):
    rows = messages(spark)
    piece_of = {"mixed": F.pmod(F.xxhash64("er_index"), F.lit(3)), "falling": 2 - (F.col("er_index") * 3 / 400).cast("int")}.get(order, F.lit(0))
    seed = spark.createDataFrame(SEED, "eq_name string, wafer_id int, wafer_seq int")
    got = streamed(spark, tmp_path, rows, seed, [rows.where(piece_of == i).orderBy(F.rand(i)) for i in range(1 if order is None else 3)])
    parsed = dose.parse_dose_warnings(rows.where(F.col("code").isin(*dose.TARGET_CODES)))
    want = state.carry_forward(state.drop_test_shots(parsed), seed)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_rows_wait_no_longer_than_the_watermark(spark, tmp_path):
    """In order of time a short delay gives the same rows, and all but the last minutes come out before the end."""
    rows = messages(spark)
    seed = spark.createDataFrame(SEED, "eq_name string, wafer_id int, wafer_seq int")
    parts = [rows.where((F.col("er_index") * 4 / 400).cast("int") == i) for i in range(4)]
    source = str(tmp_path / "in")
    seed.write.parquet(str(tmp_path / "seed"))
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(source)
    stream = jobs.dose_warnings(jobs.read_logs(spark, source, rows.schema), spark.read.parquet(str(tmp_path / "seed")), delay="10 minutes")
    jobs.run_once(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    got = spark.read.parquet(str(tmp_path / "out")).select(*dose.PARSED_COLUMNS)
    parsed = dose.parse_dose_warnings(rows.where(F.col("code").isin(*dose.TARGET_CODES)))
    want = state.carry_forward(state.drop_test_shots(parsed), seed)
    early = F.col("eq_name").isNull() | (F.col("code_occur_time") < F.lit(datetime(2026, 5, 1, 6, 29)))
    assert sorted(map(str, got.where(early).collect())) == sorted(map(str, want.where(early).collect()))
    assert got.where(~early).count() == 0


def test_late_rows_are_told(spark, tmp_path):
    rows = messages(spark)
    source = str(tmp_path / "in")
    for part in ("er_index >= 300", "er_index < 300"):
        rows.where(part).coalesce(1).write.mode("append").parquet(source)
        stream = jobs.dose_warnings(jobs.read_logs(spark, source, rows.schema), delay="10 minutes")
        if part == "er_index >= 300":
            jobs.run_once(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    with pytest.raises(jobs.LateRows):
        jobs.run_once(stream, str(tmp_path / "out"), str(tmp_path / "state"))


def test_rows_without_a_time_or_an_equipment_pass_by(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, i, "L", eq, "DW-3411", time, "b", "t", "x", text) for i, (eq, time, text) in enumerate(
            [("E", None, "exposure_handle=5"), (None, datetime(2026, 5, 1), None), ("E", datetime(2026, 5, 1), "wafer(3)"), (None, None, "")])],
        LOGS,
    )
    got = streamed(spark, tmp_path, rows, spark.createDataFrame([], "eq_name string, wafer_id int, wafer_seq int"), [rows])
    assert sorted(r.er_index for r in got.collect()) == [0, 1, 2, 3]


def test_source_files_hold_ranges_of_time(spark, tmp_path):
    rows = messages(spark)
    # So little would else be one task.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        jobs.write_logs(rows.repartition(4), str(tmp_path / "in"), most=30)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = spark.read.parquet(str(tmp_path / "in")).groupBy(F.input_file_name().alias("f"))
    spans = files.agg(F.min("er_index").alias("a"), F.max("er_index").alias("b"), F.count(F.lit(1)).alias("n")).orderBy("a").collect()
    assert all(r.n == r.b - r.a + 1 <= 30 for r in spans) and sum(r.n for r in spans) == 400
    tasks = {r.f.rsplit("/", 1)[1].split("-")[1] for r in spark.read.parquet(str(tmp_path / "in")).select(F.input_file_name().alias("f")).distinct().collect()}
    assert len(tasks) > 1


@pytest.mark.parametrize("sliced", [True, False, None])
def test_counts_of_a_run_are_those_of_its_steps(spark, sliced):
    rows = messages(spark)
    rows = rows.union(rows.where("er_index % 10 < 3"))
    window = datetime(2026, 5, 1), datetime(2026, 5, 1, 4)
    seed = spark.createDataFrame([("E0", 77, None)], "eq_name string, wafer_id int, wafer_seq int")
    scanned = sources.scan_dose_logs(rows, *window)
    kept = state.drop_test_shots(dose.parse_dose_warnings(scanned))
    want = (scanned.count(), kept.count(), pipelines.dose_table(rows, *window, seed).count())
    assert want[0] > want[1] > want[2]
    (got,) = pipelines.dose_run_summary(rows, *window, seed, sliced=sliced).collect()
    assert (got.fetched, got.parsed, got.inserted) == want
    (none,) = pipelines.dose_run_summary(rows.limit(0), *window, sliced=sliced).collect()
    assert tuple(none) == (0, 0, 0)


def test_tables_of_a_database(spark, tmp_path):
    """A JDBC table, whole and in parts, through the database that comes with Spark."""
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", str(tmp_path / "derby.log"))
    url, driver = f"jdbc:derby:{tmp_path / 'db'};create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    rows = messages(spark).selectExpr("er_index", "eq_name", "code", "cast(code_occur_time as timestamp) as code_occur_time")
    rows.coalesce(1).write.format("jdbc").options(url=url, dbtable="logs", driver=driver).save()
    whole = sources.from_database(spark, url, "logs", driver=driver)
    parts = sources.from_database(spark, url, "logs", fetch=50, split_by=("er_index", 0, 400, 4), driver=driver)
    assert parts.rdd.getNumPartitions() == 4
    want = sorted(map(tuple, rows.collect()), key=str)
    for read in (whole, parts):
        assert sorted(map(tuple, read.collect()), key=str) == want
    some = sources.from_database(spark, url, '(select mod("er_index", 7) as "k", count(*) as "n" from logs group by mod("er_index", 7)) t', driver=driver)
    assert {r.k: r.n for r in some.collect()} == {i: len(range(i, 400, 7)) for i in range(7)}


def test_root_causes(spark, tmp_path):
    kinds = ", ".join(f"{c} {'timestamp_ntz' if c == 'code_occur_time' else 'string'}" for c in root_cause.SOURCE_COLUMNS)
    rows = spark.createDataFrame([("L1", "E", "ER", "C", None, "b", "t", "x", text, "r", "k", None) for text in (REPORT, "other", None)], kinds)
    rows.write.parquet(str(tmp_path / "in"))
    jobs.run_once(jobs.root_causes(jobs.read_logs(spark, str(tmp_path / "in"), rows.schema)), str(tmp_path / "out"), str(tmp_path / "state"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, got.collect())) == sorted(map(str, root_cause.parse_root_causes(rows).collect()))


def test_files_are_read_once(spark, tmp_path):
    folder, out, kept = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    (folder / "20240101").mkdir(parents=True)
    (folder / "20240101" / "a.txt").write_text("key=1")
    (folder / "20240101" / "k.txt").write_bytes("값=2".encode("cp949"))
    (folder / "20240101" / "image.tif").write_bytes(b"x")
    for _ in range(2):
        jobs.run_once(jobs.text_bodies(spark, f"file://{folder}"), out, kept)
        assert sorted(r.text for r in spark.read.parquet(out).collect()) == ["key=1", "값=2"]
    (folder / "20240101" / "b.txt").write_text("late")
    jobs.run_once(jobs.text_bodies(spark, f"file://{folder}"), out, kept)
    assert spark.read.parquet(out).count() == 3


@pytest.mark.parametrize("broken", ["before the entry", "after the entry", None])
def test_batches_count_once(spark, tmp_path, monkeypatch, broken):
    """Runs that die on either side of a batch's entry, and are run again, give the rows of one that does not."""
    folder, target, kept = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    folder.mkdir()
    lines = lambda bodies: bodies.select("source_file", F.explode(F.split("text", "\n")).alias("line"))
    stream = lambda: jobs.text_bodies(spark, f"file://{folder}", files_per_batch=2)
    commit = ingest._commit
    died = []

    def dying(*args):
        if broken == "after the entry":
            commit(*args)
        if len(died) < 2:
            died.append(args)
            raise RuntimeError("gone")
        commit(*args)

    for run in range(2):
        for i in range(3):
            (folder / f"{run}{i}.txt").write_text(f"a{run}\nb{i}")
        if broken is None:
            ingest.ingest_once(stream(), target, kept, lines)
            continue
        with monkeypatch.context() as patched:
            patched.setattr(ingest, "_commit", dying)
            died.clear()
            for _ in range(2):
                try:
                    ingest.ingest_once(stream(), target, kept, lines)
                except Exception as error:
                    assert "gone" in str(error)
        ingest.ingest_once(stream(), target, kept, lines)
    got = sorted(r.line for r in ingest.rows(spark, target).collect())
    assert got == sorted([f"a{run}" for run in range(2) for _ in range(3)] + [f"b{i}" for i in range(3) for _ in range(2)])
    assert ingest.entries(spark, target).agg(F.sum("n_rows")).first()[0] == 12
    files = spark.createDataFrame([(f"file:{folder}/{run}{i}.txt",) for run in range(2) for i in range(4)], "path string")
    left = ledger.unprocessed(files, ingest.consumed(spark, target)).collect()
    assert sorted(r.path[-6:] for r in left) == ["03.txt", "13.txt"]


def test_a_batch_without_entry_is_not_seen_and_another_stream_is_refused(spark, tmp_path):
    target = str(tmp_path / "out")
    bodies = spark.createDataFrame([("a", "x"), ("b", "y")], "source_file string, text string")
    ingest.write_batch(bodies, 0, target, lambda b: b)
    bodies.write.parquet(f"{target}/rows/batch=1")
    assert sorted(r.batch for r in ingest.rows(spark, target).collect()) == [0, 0]
    ingest.write_batch(bodies, 0, target, lambda b: b)
    assert ingest.rows(spark, target).count() == 2
    with pytest.raises(ingest.AnotherStream):
        ingest.write_batch(bodies.where("source_file = 'a'"), 0, target, lambda b: b)


def test_sources_are_archived_after_their_batch(spark, tmp_path):
    folder, target, kept = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    folder.mkdir()
    spark.conf.set("spark.sql.streaming.fileSource.cleaner.numThreads", "0")
    try:
        for i in range(3):
            (folder / f"{i}.txt").write_text(f"line {i}")
            stream = jobs.text_bodies(spark, f"file://{folder}", archive=str(tmp_path / "old"))
            ingest.ingest_once(stream, target, kept, lambda b: b.select("text"))
    finally:
        spark.conf.unset("spark.sql.streaming.fileSource.cleaner.numThreads")
    assert sorted(r.text for r in ingest.rows(spark, target).collect()) == ["line 0", "line 1", "line 2"]
    there = {p.name for p in folder.glob("*.txt")}
    assert "0.txt" not in there and "2.txt" in there
    assert {p.name for p in (tmp_path / "old").rglob("*.txt")} == {"0.txt", "1.txt", "2.txt"} - there
