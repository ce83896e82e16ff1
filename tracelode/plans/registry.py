"""Every registered query by name, with the SQL that states the same result."""

from __future__ import annotations

import uuid
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from tracelode.functions import dose, root_cause
from tracelode.functions.text import normalize_contents, snake_code, strip_trailing_period
from tracelode.operators import audit, filenames, ledger, matching, state, textlines
from tracelode.operators.ledger_table import LedgerTable
from tracelode.plans import fixtures, pipelines, sql
from tracelode.sources import files as inventories
from tracelode.sources import database, logs, sinks
from tracelode.sources.day_folders import day_folders
from tracelode.sources.scratch import scratch_dir
from tracelode.streaming import ingest, jobs, matches

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

ANCHOR = "2024-01-02"


def query(oracle: str | None = None, name: str | None = None):
    """Registers a function under `name`, or its own."""

    def put(run):
        QUERIES[name or run.__name__] = run
        if oracle is not None:
            ORACLES[name or run.__name__] = oracle
        return run

    return put


# Dose-warning logs


def _scanned(spark, d, window=fixtures.WINDOW):
    return logs.scan_dose_logs(fixtures.er_raw(spark, d), *logs.day_window(start=window[0], end=window[1]))


def _parsed(spark, d):
    return dose.parse_dose_warnings(_scanned(spark, d))


def _busy(spark, d):
    """The one count of a query, over the scan of both windows."""
    return state.busy(_scanned(spark, d, (fixtures.SEED_WINDOW[0], fixtures.WINDOW[1])))


def _seed(spark, d, sliced=None):
    return state.latest_wafer_state(pipelines.dose_table(fixtures.er_raw(spark, d), *fixtures.SEED_WINDOW, sliced=sliced))


def _table(spark, d, sliced=None):
    return pipelines.dose_pipeline(fixtures.er_raw(spark, d), fixtures.WINDOW, fixtures.SEED_WINDOW, sliced=sliced)


@query(sql.raw([], "select * from er_raw"))
def fixture_er_raw(spark, d):
    return fixtures.er_raw(spark, d)


@query(sql.query([sql.EUV_RAW], "select * from euv_raw"))
def fixture_euv_raw(spark, d):
    return fixtures.euv_raw(spark, d)


@query(sql.raw([sql.PARSE[0]], "select * from scanned"))
def scan_raw_window(spark, d):
    return _scanned(spark, d)


@query(sql.query([sql.EUV_RAW, sql.EUV_SCAN], "select * from scanned"))
def scan_euv_window(spark, d):
    return logs.scan_root_cause_logs(fixtures.euv_raw(spark, d), *fixtures.WINDOW)


@query(sql.raw([sql.scan("scanned", (datetime(2024, 1, 12), datetime(2024, 1, 14)))], "select * from scanned"))
def scan_day_partition(spark, d):
    path = scratch_dir(spark, "days")
    sinks.overwrite_days(fixtures.er_raw(spark, d), path)
    return logs.scan_dose_logs(spark.read.parquet(path), datetime(2024, 1, 12), datetime(2024, 1, 14))


@query(sql.raw([], "select er_index, code, eq_name from er_raw where code = 'LO-0061' and er_index >= 100"))
def parametrised_select(spark, d):
    statement = "select er_index, code, eq_name from {logs} where code = :code and er_index >= :least"
    return logs.select(spark, statement, {"code": "LO-0061", "least": 100}, logs=fixtures.er_raw(spark, d))


@query(
    sql.raw(
        [],
        "select er_index, code, case when starts_with(code, 'DW-') then 'DW' when starts_with(code, 'LO-') then 'LO' "
        "else 'other' end as family from er_raw",
    )
)
def classify_code_family(spark, d):
    return fixtures.er_raw(spark, d).select("er_index", "code", dose.code_family(F.col("code")).alias("family"))


@query(sql.raw(sql.PARSE, "select er_index, exposure_handle, action_handle, de_err, n_slit from parsed"))
def parse_dose_fields(spark, d):
    return _parsed(spark, d).select("er_index", "exposure_handle", "action_handle", "de_err", "n_slit")


@query(sql.raw(sql.PARSE, "select er_index, wafer_id, wafer_seq from parsed"))
def parse_wafer_fields(spark, d):
    return _parsed(spark, d).select("er_index", "wafer_id", "wafer_seq")


@query(sql.raw(sql.PARSE, "select * from parsed"))
def parse_dose_warning(spark, d):
    return _parsed(spark, d)


@query(sql.raw(sql.LAG, "select er_index, eq_name, exposure_handle, previous_handle from lagged"))
def handle_lag(spark, d):
    return state.with_previous_handle(_parsed(spark, d), sliced=_busy(spark, d)).select("er_index", "eq_name", "exposure_handle", "previous_handle")


@query(sql.raw(sql.KEEP, "select * from kept"))
def drop_test_shots(spark, d):
    return state.drop_test_shots(_parsed(spark, d), sliced=_busy(spark, d))


@query(
    sql.raw(
        sql.LAG,
        "select *, exposure_handle - previous_handle as handle_diff from lagged where exposure_handle - previous_handle >= 1000",
    )
)
def test_shots(spark, d):
    return state.test_shots(_parsed(spark, d), sliced=_busy(spark, d))


@query(sql.raw([*sql.KEEP, sql.filled("filled", "kept")], "select * from filled"))
def carry_forward(spark, d):
    sliced = _busy(spark, d)
    return state.carry_forward(state.drop_test_shots(_parsed(spark, d), sliced=sliced, keep=True), sliced=sliced)


@query(sql.raw([*sql.KEEP, *sql.SEED, sql.filled("filled", "kept", "seed")], "select * from filled"))
def carry_forward_seeded(spark, d):
    sliced = _busy(spark, d)
    kept = state.drop_test_shots(_parsed(spark, d), sliced=sliced, keep=True)
    return state.carry_forward(kept, _seed(spark, d, sliced), sliced=sliced)


@query(sql.raw(sql.SEED, "select * from seed"))
def latest_wafer_state(spark, d):
    return _seed(spark, d)


@query(sql.raw(sql.PIPELINE, "select * from result"))
def raw_pipeline(spark, d):
    return _table(spark, d)


@query(sql.raw(sql.PIPELINE, "select * from result"))
def sink_raw_projection(spark, d):
    path = scratch_dir(spark, "dose")
    sinks.append_by_day(_table(spark, d), path)
    return spark.read.parquet(path).select(*dose.PARSED_COLUMNS)


@query(
    sql.raw(
        [*sql.PARSE, "twice as (select * from parsed union all select * from parsed where er_index % 5 = 0)"],
        "select er_index, code, exposure_handle, count(*) over () as n_rows from twice",
    )
)
def append_with_statistics(spark, d):
    """Rows appended to a table in two runs, and their number by the table's own statistics."""
    rows = _parsed(spark, d)
    name = f"appended_{uuid.uuid4().hex}"
    where = scratch_dir(spark, name)
    spark.createDataFrame([], rows.schema).write.parquet(where)
    spark.catalog.createTable(name, path=where, source="parquet")
    sinks.append_to_table(rows, name)
    sinks.append_to_table(rows.where("er_index % 5 = 0"), name, analyze=True)
    told = [r["data_type"] for r in spark.sql(f"describe extended {name}").collect() if r["col_name"] == "Statistics"]
    n = int(told[0].split(",")[-1].split(" rows")[0]) if told else None
    spark.sql(f"drop table {name}")
    return spark.read.parquet(where).select("er_index", "code", "exposure_handle", F.lit(n).cast("long").alias("n_rows"))


@query(
    sql.raw(
        [*sql.PARSE, "twice as (select * from parsed union all select * from parsed where hour(code_occur_time) < 6)"],
        "select cast(code_occur_time as date) as event_date, count(*) as n_rows from twice where code_occur_time is not null group by all",
    )
)
def append_with_partition_statistics(spark, d):
    """Days of a partitioned table, appended to in two runs, with their rows by the catalog's statistics."""
    rows = sinks.with_day(_parsed(spark, d))
    name = f"by_day_{uuid.uuid4().hex}"
    where = scratch_dir(spark, name)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    spark.sql(f"create table {name} ({columns}) using parquet partitioned by (event_date) location '{where}'")
    days = {*sinks.append_days_to_table(rows, name), *sinks.append_days_to_table(rows.where(F.hour("code_occur_time") < 6), name)}
    found = sinks.rows_by_statistics(spark, name, "event_date", sorted(days))
    spark.sql(f"drop table {name}")
    return spark.createDataFrame(sorted(found.items()), "event_date date, n_rows long")


@query(sql.raw(sql.PARSE, "select er_index, eq_name, code, code_occur_time, contents, exposure_handle, de_err from parsed"))
def database_load(spark, d):
    """Rows loaded into a database under one load id, twice, and read back. The address is the setting `tracelode.jdbc.url`; a local
    session without it takes the database in memory that comes with Spark, which other machines could not reach."""
    url = spark.conf.get("tracelode.jdbc.url", "")
    if not url:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set tracelode.jdbc.url to a database that all executors reach")
        url = "jdbc:derby:memory:loads;create=true"
    rows = _parsed(spark, d).select("er_index", "eq_name", "code", "code_occur_time", "contents", "exposure_handle", "de_err")
    load = uuid.uuid4().hex
    for _ in range(2):
        database.load_table(rows, url, f"er_raw_{load}", load)
    return logs.from_database(spark, url, database.quoted(f"er_raw_{load}"), preferTimestampNTZ=True)


@query(
    sql.raw(
        [*sql.PARSE, "twice as (select * from parsed union all select * from parsed where er_index % 5 = 0)"],
        "select distinct * from twice",
    )
)
def dedup_exact_rows(spark, d):
    rows = _parsed(spark, d)
    return sinks.distinct_rows(rows.unionByName(rows.where("er_index % 5 = 0")))


@query(
    sql.raw(
        sql.PARSE,
        "select er_index, code_occur_time, code from parsed where cast(code_occur_time as date) <> date '2024-01-12' "
        "or er_index % 2 = 0",
    )
)
def overwrite_partition(spark, d):
    path = scratch_dir(spark, "overwrite")
    rows = _parsed(spark, d).select("er_index", "code_occur_time", "code")
    sinks.overwrite_days(rows, path)
    sinks.overwrite_days(rows.where("to_date(code_occur_time) = date'2024-01-12' and er_index % 2 = 0"), path)
    return spark.read.parquet(path).select("er_index", "code_occur_time", "code")


@query(sql.raw(sql.PARSE, "select er_index, eq_name, code, contents, exposure_handle, de_err from parsed"))
def csv_roundtrip(spark, d):
    path = scratch_dir(spark, "csv")
    rows = _parsed(spark, d).select("er_index", "eq_name", "code", "contents", "exposure_handle", "de_err")
    sinks.write_csv(rows, path)
    return sinks.read_csv(spark, path, rows.schema)


@query(
    sql.raw(
        sql.PIPELINE, "select cast(code_occur_time as date) as event_date, count(*) as n_rows from result group by all"
    )
)
def rows_per_partition(spark, d):
    return sinks.rows_per_day(_table(spark, d))


@query(
    sql.raw(
        sql.PIPELINE,
        "select (select count(*) from scanned) as fetched, (select count(*) from kept) as parsed, "
        "(select count(*) from result) as inserted",
    )
)
def log_run_summary(spark, d):
    sliced = _busy(spark, d)
    return pipelines.dose_run_summary(fixtures.er_raw(spark, d), *fixtures.WINDOW, _seed(spark, d, sliced), sliced=sliced)


@query(
    sql.raw(
        sql.PIPELINE,
        "select (select count(*) from scanned) as fetched, (select count(*) from kept) as parsed, "
        f"(select count(*) from result) as inserted, (select coalesce(sum({sql.unfit_values('code', 'contents')}), 0)::bigint from scanned) as nulled",
    ).replace("n_slit=' ||", "n_slit=99999999' ||")
)
def load_with_counts(spark, d):
    """What a load saw while it wrote, of messages some of whose numbers are too long for their column."""
    longer = F.replace("contents", F.lit("n_slit="), F.lit("n_slit=99999999"))
    logs_ = fixtures.er_raw(spark, d).withColumn("contents", longer)
    seed, sliced = _seed(spark, d), _busy(spark, d)
    counts = pipelines.dose_load(logs_, scratch_dir(spark, "load"), *fixtures.WINDOW, seed, sliced=sliced)
    return spark.createDataFrame([counts], "fetched long, parsed long, inserted long, nulled long")


@query(
    sql.raw(
        [
            *sql.PIPELINE,
            "flow as (select *, lag(exposure_handle) over (partition by eq_name order by code_occur_time, er_date, er_index) as prev "
            "from result where code like 'DW-%' and exposure_handle is not null)",
        ],
        "select eq_name, code, code_occur_time, er_date, er_index, prev as prev_exposure_handle, exposure_handle, "
        "exposure_handle - prev as exposure_handle_diff from flow where exposure_handle - prev > 1000",
    )
)
def handle_jump_audit(spark, d):
    sliced = _busy(spark, d)
    return state.handle_jump_audit(_table(spark, d, sliced), sliced=sliced)


@query(
    sql.raw(
        [*sql.PIPELINE, "there as (select * from result where er_index % 13 <> 0)"],
        "select r.er_date, r.er_index, r.er_line, r.eq_name, r.code, r.code_occur_time, r.belong, r.type, r.title, "
        "nullif(regexp_extract(r.contents, 'exposure_handle\\s*[:=]\\s*([0-9]+)', 1), '') as exposure_handle_raw, r.contents "
        "from scanned r where not exists (select 1 from there p where p.er_date = r.er_date and p.er_index = r.er_index "
        "and p.er_line = r.er_line and p.eq_name = r.eq_name and p.code = r.code and p.code_occur_time = r.code_occur_time)",
    )
)
def raw_missing_from_parsed(spark, d):
    there = _table(spark, d).where("er_index % 13 <> 0")
    return audit.missing_from_parsed(fixtures.er_raw(spark, d), there, *fixtures.WINDOW)


_FAULTS = "er_index % 13 <> 0 or eq_name <> 'EQ3' or cast(code_occur_time as date) <> date '2024-01-12'"


@query(
    sql.raw(
        [*sql.PIPELINE, f"there as (select * from result where {_FAULTS})"],
        "select r.er_date, r.er_index, r.er_line, r.eq_name, r.code, r.code_occur_time, r.belong, r.type, r.title, "
        "nullif(regexp_extract(r.contents, 'exposure_handle\\s*[:=]\\s*([0-9]+)', 1), '') as exposure_handle_raw, r.contents "
        "from scanned r where not exists (select 1 from there p where p.er_date = r.er_date and p.er_index = r.er_index "
        "and p.er_line = r.er_line and p.eq_name = r.eq_name and p.code = r.code and p.code_occur_time = r.code_occur_time)",
    )
)
def raw_missing_reconciled(spark, d):
    """The audit by counts and checksums for each day and machine; only groups that differ are joined."""
    there = _table(spark, d).where(_FAULTS)
    return audit.missing_by_groups(fixtures.er_raw(spark, d), there, *fixtures.WINDOW)


@query(
    sql.raw(
        [*sql.PARSE, "twice as (select code_occur_time from parsed union all select code_occur_time from parsed where er_index % 11 = 0)"],
        "select code_occur_time, count(*) as n_rows from twice group by all having count(*) > 1",
    )
)
def key_violations(spark, d):
    rows = _parsed(spark, d)
    return audit.repeated_keys(rows.unionByName(rows.where("er_index % 11 = 0")), ["code_occur_time"])


@query(
    sql.raw(
        [],
        "select 'eq_name' as column_name, count(*) filter (eq_name is null) as n_nulls from er_raw union all "
        "select 'contents', count(*) filter (contents is null) from er_raw union all "
        "select 'code_occur_time', count(*) filter (code_occur_time is null) from er_raw",
    )
)
def null_violations(spark, d):
    return audit.null_counts(fixtures.er_raw(spark, d), ["eq_name", "contents", "code_occur_time"])


# Root-cause logs


def _euv(spark, d):
    return logs.scan_root_cause_logs(fixtures.euv_raw(spark, d), *fixtures.WINDOW)


def _causes(spark, d):
    return root_cause.parse_root_causes(_euv(spark, d))


_PARSED_EUV = [*sql.EUV, sql.GATED, sql.CAUSES]
_KEY = "eq_name, code_occur_time"


@query(sql.query(sql.EUV, f"select {_KEY}, t as text from normalized"), "normalize_contents")
def normalize_contents_text(spark, d):
    return _euv(spark, d).select("eq_name", "code_occur_time", normalize_contents(F.coalesce("contents", F.lit(""))).alias("text"))


@query(sql.query(sql.EUV, f"select {_KEY}, ({sql.GATE}) as passes from normalized"))
def root_cause_gate(spark, d):
    text = normalize_contents(F.coalesce("contents", F.lit("")))
    return _euv(spark, d).select("eq_name", "code_occur_time", text.alias("t")).select(
        "eq_name", "code_occur_time", root_cause.is_root_cause(F.col("t")).alias("passes")
    )


def _fields(spark, d, rules):
    text = normalize_contents(F.coalesce("contents", F.lit("")))
    rows = _euv(spark, d).select("eq_name", "code_occur_time", text.alias("t"))
    return root_cause.with_fields(rows, "t", rules).drop("t")


def _fields_sql(rules):
    return sql.query(sql.EUV, f"select {_KEY}, {', '.join(f'{sql.field(r, "t")} as {r.name}' for r in rules)} from normalized")


@query(_fields_sql(root_cause.IDENTITY_RULES))
def parse_root_cause_identity(spark, d):
    return _fields(spark, d, root_cause.IDENTITY_RULES)


@query(_fields_sql(root_cause.METRIC_RULES))
def parse_root_cause_metrics(spark, d):
    return _fields(spark, d, root_cause.METRIC_RULES)


@query(_fields_sql(root_cause.INTEGRAL_RULES))
def parse_integral_metrics(spark, d):
    return _fields(spark, d, root_cause.INTEGRAL_RULES)


@query(sql.query(_PARSED_EUV, f"select {_KEY}, min_dose_error, max_dose_error, dose_error from causes"))
def dominant_dose_error(spark, d):
    return _causes(spark, d).select("eq_name", "code_occur_time", "min_dose_error", "max_dose_error", "dose_error")


@query(
    "select event_id, nullif(regexp_replace(regexp_replace(lower(props), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), '') as code from events",
    "snake_code",
)
def snake_code_of_props(spark, d):
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", snake_code(F.col("props")).alias("code"))


@query(sql.raw([], f"select er_index, {sql.strip_trailing_period('contents')} as bare from er_raw"), "strip_trailing_period")
def strip_trailing_period_of_messages(spark, d):
    return fixtures.er_raw(spark, d).select("er_index", strip_trailing_period(F.col("contents")).alias("bare"))


@query(sql.query([sql.TEXT_FILES], f"select source_file, {sql.strip_trailing_period('text')} as whole from text_files"))
def strip_trailing_period_of_texts(spark, d):
    return fixtures.text_files(spark, d).select("source_file", strip_trailing_period(F.col("text")).alias("whole"))


@query(_fields_sql([r for r in root_cause.IDENTITY_RULES if r.kind == "time"]))
def parse_iso_time(spark, d):
    return _fields(spark, d, tuple(r for r in root_cause.IDENTITY_RULES if r.kind == "time"))


(_TIME,) = (r for r in root_cause.IDENTITY_RULES if r.kind == "time")


@query(
    sql.query(
        [*sql.EUV, sql.GATED],
        f"select {_KEY}, {sql.field(_TIME, 't')} as source_code_occur_time, "
        f"epoch_us(try_cast(upper({sql.group('t', _TIME.patterns[0])}) as timestamptz)) as instant_us from gated",
    )
)
def parse_iso_instant(spark, d):
    """Wall-clock time and instant (microseconds since 1970, UTC) of the reports' times."""
    causes = root_cause.parse_root_causes(_euv(spark, d), instants=True)
    return causes.select("eq_name", "code_occur_time", "source_code_occur_time", F.unix_micros("source_code_occur_instant").alias("instant_us"))


@query(sql.query(_PARSED_EUV, f"select {sql.EUV_PARSED} from causes"))
def parse_root_cause(spark, d):
    return _causes(spark, d)


@query(sql.query(_PARSED_EUV, f"select distinct {sql.EUV_PARSED} from causes"))
def euv_pipeline(spark, d):
    return pipelines.root_cause_pipeline(fixtures.euv_raw(spark, d), fixtures.WINDOW)


@query(sql.query(_PARSED_EUV, f"select distinct {sql.EUV_PARSED} from causes"))
def sink_euv_projection(spark, d):
    path = scratch_dir(spark, "causes")
    sinks.append_by_day(pipelines.root_cause_pipeline(fixtures.euv_raw(spark, d), fixtures.WINDOW), path)
    return spark.read.parquet(path).select(*root_cause.PARSED_COLUMNS)


# Inspection files


def _named(spark, d, kind):
    return filenames.accepted(fixtures.files(spark, d)).where(F.col("kind") == kind)


def _stored(named, name):
    """Named files, written once in order of time and read from there: a span of time is then read by itself."""
    path = scratch_dir(named.sparkSession, name)
    columns = ["file_id", "kind", "prefix", "folder_date", "path", "file_ts"]
    named.select(*columns).repartitionByRange("file_ts").sortWithinPartitions("file_ts").write.parquet(path)
    return named.sparkSession.read.parquet(path)


def _exclusive(spark, d):
    return matching.match_exclusive(_named(spark, d, "text"), _named(spark, d, "image"))


def _outputs(spark, d, every):
    images = _named(spark, d, "image").where(f"file_id % {every} = 0")
    return images.select(filenames.output_path(F.col("path")).alias("output_path"))


@query(sql.files([], "select file_id, kind, path from files where folder_date = date '2024-01-02'"))
def file_inventory(spark, d):
    return fixtures.files(spark, d).where("folder_date = date'2024-01-02'").select("file_id", "kind", "path")


def _laid_out(files, root):
    """Empty files at the paths of an inventory, each written by a task; gives their number."""

    def write(batches):
        from pyarrow import fs

        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, base = fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)
                system.create_dir(f"{base}{path}".rsplit("/", 1)[0], recursive=True)
                system.open_output_stream(f"{base}{path}").close()
            yield batch

    return files.select("path").distinct().mapInArrow(write, "path string").count()


@query(sql.files([], "select distinct kind, path from files where folder_date = date '2024-01-02'"))
def file_listing(spark, d):
    """A day's files laid out in folders and listed from there, a folder for each task."""
    root = scratch_dir(spark, "folders")
    _laid_out(fixtures.files(spark, d).where("folder_date = date'2024-01-02'"), root)
    kinds = {"text": "RUBI", "image": "RUIP"}
    found = [day_folders(spark, f"{root}/{folder}", list(inventories.two_days(ANCHOR))).withColumn("kind", F.lit(kind)) for kind, folder in kinds.items()]
    return found[0].union(found[1]).select("kind", F.substring("path", len(root) + 1, 4000).alias("path"))


@query(sql.files([], "select file_id, kind, path, folder_date from files where folder_date in (date '2024-01-01', date '2024-01-02')"))
def two_day_window(spark, d):
    return inventories.in_two_days(fixtures.files(spark, d), ANCHOR).select("file_id", "kind", "path", "folder_date")


@query(sql.files([], "select file_id, path, prefix, file_ts from named where ok"))
def parse_file_names(spark, d):
    return filenames.accepted(fixtures.files(spark, d)).select("file_id", "path", "prefix", "file_ts")


@query(sql.files([], "select file_id, kind, path from named where not ok"))
def rejected_file_names(spark, d):
    return filenames.rejected(fixtures.files(spark, d)).select("file_id", "kind", "path")


@query(
    sql.files(
        [],
        f"select file_id, case when kind = 'image' then {sql.output('path')} end as output_path, "
        "case when kind = 'image' then path[7:] else path[2:] end as relative_path from files",
    )
)
def derive_output_paths(spark, d):
    return fixtures.files(spark, d).select(
        "file_id",
        filenames.output_path(F.col("path")).alias("output_path"),
        filenames.relative_path(F.col("path"), "/RUIP").alias("relative_path"),
    )


@query(
    sql.files(
        [sql.FORWARD],
        "select prefix, folder_date, image_id, image_path, image_ts, text_id, text_path, text_ts, diff_seconds from forward where r = 1",
    )
)
def match_image_to_text(spark, d):
    return matching.match_image_to_text(_named(spark, d, "image"), _named(spark, d, "text"))


@query(
    sql.files(
        [sql.BACKWARD],
        "select prefix, text_id, text_path, text_ts, image_id, image_path, image_ts, diff_seconds from backward where r = 1",
    )
)
def match_text_to_image(spark, d):
    return matching.match_text_to_image(_named(spark, d, "text"), _named(spark, d, "image"))


@query(sql.GREEDY)
def match_exclusive(spark, d):
    return _exclusive(spark, d)


#: Runs that a history is cut into, at most.
MOST_RUNS = 8


def run_cuts(first: date, last: date) -> list[datetime]:
    """Midnights that cut the days from `first` to `last` into runs of whole days, at most MOST_RUNS."""
    n = (last - first).days + 1
    start, step = datetime.combine(first, datetime.min.time()), -(-n // MOST_RUNS)
    return [start + timedelta(days=min(i, n)) for i in range(0, n + step, step)]


@query(sql.GREEDY)
def match_exclusive_by_runs(spark, d):
    """The exclusive match in runs, each over its own files and what the one before left: daily ones, but of more days each where
    the history is longer than MOST_RUNS days, as a run costs seconds of its own."""
    named = _stored(filenames.accepted(fixtures.files(spark, d)), "named")
    ends = named.agg(F.to_date(F.min("file_ts")).alias("first"), F.to_date(F.max("file_ts")).alias("last")).first()
    if ends["first"] is None:
        return _exclusive(spark, d)
    return pipelines.matches_by_runs(named, run_cuts(ends["first"], ends["last"]), scratch_dir(spark, "match-runs"))


@query(
    sql.files(
        [sql.STACK],
        "select file_id, path, prefix, file_ts from images where file_id not in (select image_id from exclusive where image_id is not null)",
    )
)
def unmatched_images(spark, d):
    return matching.unmatched_images(_named(spark, d, "image"), _exclusive(spark, d)).select("file_id", "path", "prefix", "file_ts")


@query(
    sql.files(
        [sql.FORWARD, sql.PUBLISHED, sql.PREPARED],
        f"select image_id, text_id, {sql.output('image_path')} as output_path, {sql.action('image_path')} as action from forward where r = 1",
    )
)
def publish_plan(spark, d):
    matched = matching.match_image_to_text(_named(spark, d, "image"), _named(spark, d, "text"))
    plan = filenames.publish_plan(matched, _outputs(spark, d, 5), _outputs(spark, d, 7))
    return plan.select("image_id", "text_id", "output_path", "action")


@query(sql.files([sql.PUBLISHED], f"select file_id, {sql.output('path')} as output_path from images where {sql.output('path')} in (select output_path from published)"))
def already_published(spark, d):
    return filenames.already_published(_named(spark, d, "image"), _outputs(spark, d, 5)).select("file_id", "output_path")


@query(sql.files([], "select folder_date, count(*) filter (kind = 'text') as texts, count(*) filter (kind = 'image') as images from files group by all"))
def files_per_day(spark, d):
    return inventories.files_per_day(fixtures.files(spark, d))


@query(sql.files([], "select file_id, path from files where modified < timestamp '2024-01-01 23:30:00'"))
def stale_files(spark, d):
    return inventories.stale_files(fixtures.files(spark, d), datetime(2024, 1, 4, 23, 30)).select("file_id", "path")


@query(
    sql.files(
        [
            "one as (select path, max(size) as size from files group by path)",
            "copies as (select path, case when size % 10 = 1 then size + 1 else size end as size from one where size % 10 <> 2)",
        ],
        "select a.path, a.size as source_size, b.size as copy_size from one a left join copies b using (path) where a.size is distinct from b.size",
    )
)
def size_mismatches(spark, d):
    one = fixtures.files(spark, d).groupBy("path").agg(F.max("size").alias("size"))
    copies = one.where("size % 10 <> 2").selectExpr("path", "case when size % 10 = 1 then size + 1 else size end as size")
    return inventories.size_mismatches(one, copies)


@query(sql.files([], "select file_id, path from files where path not in (select path from files where file_id % 4 = 0)"))
def unprocessed_files(spark, d):
    every = fixtures.files(spark, d)
    return ledger.unprocessed(every, every.where("file_id % 4 = 0")).select("file_id", "path")


@query(
    sql.files(
        [sql.FORWARD],
        "select outcome, count(*) as n_files from (select case when not ok then 'error' when file_id in "
        "(select image_id from forward) then 'processed' else 'skipped' end as outcome from named where kind = 'image') group by all",
    )
)
def file_run_summary(spark, d):
    return audit.outcome_counts(pipelines.file_outcomes(fixtures.files(spark, d)))


# Ledgers


def _now():
    return F.lit(datetime(2024, 2, 1)).cast("timestamp_ntz")


def _unique(spark, d):
    first = F.min_by(F.struct("file_id", "prefix", "file_ts"), "file_id")
    return _named(spark, d, "image").groupBy("path").agg(first.alias("f")).select(F.col("path").alias("source_file"), "f.*")


def _ledger(spark, d):
    return _unique(spark, d).where("file_id % 3 = 0").select(
        "source_file",
        "prefix",
        F.col("file_ts").alias("image_ts"),
        F.lit("old.txt").alias("matched_text_file"),
        F.col("file_ts").alias("matched_text_ts"),
        F.lit(0).cast("long").alias("matched_diff_seconds"),
        F.lit(None).cast("string").alias("output_remote_file"),
        F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz").alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"),
    )


def _news(spark, d):
    return _unique(spark, d).where("file_id % 2 = 0").select(
        "source_file",
        "prefix",
        F.col("file_ts").alias("image_ts"),
        F.lit("new.txt").alias("matched_text_file"),
        F.expr("file_ts + interval 60 seconds").alias("matched_text_ts"),
        F.lit(60).cast("long").alias("matched_diff_seconds"),
        filenames.output_path(F.col("source_file")).alias("output_remote_file"),
    )


_BOOKS = [sql.UNIQUE, sql.LEDGER, sql.NEWS]


def _ledger_sql(select):
    return sql.files(_BOOKS, select)


@query(
    _ledger_sql(
        f"select source_file, n.prefix, n.image_ts, n.matched_text_file, n.matched_text_ts, n.matched_diff_seconds, n.output_remote_file, "
        f"coalesce(l.created_at, {sql.NOW}) as created_at, case when l.source_file is not null then {sql.NOW} end as updated_at "
        f"from news n left join ledger l using (source_file) union all "
        f"select {sql.LEDGER_COLUMNS} from ledger where source_file not in (select source_file from news)"
    )
)
def ledger_upsert(spark, d):
    return ledger.upsert(_ledger(spark, d), _news(spark, d), _now())


@query(
    _ledger_sql(
        f"select {sql.LEDGER_COLUMNS} from ledger union all select source_file, prefix, image_ts, null, null, null, null, {sql.NOW}, null "
        "from news where source_file not in (select source_file from ledger)"
    )
)
def ledger_insert_if_absent(spark, d):
    return ledger.insert_if_absent(_ledger(spark, d), _news(spark, d), _now())


@query(
    _ledger_sql(
        "select source_file, l.prefix, l.image_ts, case when n.source_file is null then l.matched_text_file else n.matched_text_file end as matched_text_file, "
        "case when n.source_file is null then l.matched_text_ts else n.matched_text_ts end as matched_text_ts, "
        "case when n.source_file is null then l.matched_diff_seconds else n.matched_diff_seconds end as matched_diff_seconds, "
        f"l.output_remote_file, l.created_at, case when n.source_file is null then l.updated_at else {sql.NOW} end as updated_at "
        "from ledger l left join news n using (source_file)"
    )
)
def ledger_update_match(spark, d):
    return ledger.update_match(_ledger(spark, d), _news(spark, d), _now())


@query(
    _ledger_sql(
        "select source_file, l.prefix, l.image_ts, l.matched_text_file, l.matched_text_ts, l.matched_diff_seconds, "
        "coalesce(n.output_remote_file, l.output_remote_file) as output_remote_file, l.created_at, "
        f"case when n.source_file is null then l.updated_at else {sql.NOW} end as updated_at from ledger l left join news n using (source_file)"
    )
)
def ledger_finalize(spark, d):
    return ledger.finalize(_ledger(spark, d), _news(spark, d).select("source_file", "output_remote_file"), _now())


@query(_ledger_sql(f"select {sql.LEDGER_COLUMNS} from ledger where source_file not in (select source_file from news)"))
def ledger_remove_unmatched(spark, d):
    return ledger.remove(_ledger(spark, d), _news(spark, d))


@query(
    _ledger_sql(
        f"select * from (select source_file, n.prefix, n.image_ts, n.matched_text_file, n.matched_text_ts, n.matched_diff_seconds, n.output_remote_file, "
        f"coalesce(l.created_at, {sql.NOW}) as created_at, case when l.source_file is not null then {sql.NOW} end as updated_at "
        f"from news n left join ledger l using (source_file) where source_file in (select path from uniq where file_id % 10 = 0) union all "
        f"select {sql.LEDGER_COLUMNS} from ledger where source_file not in (select path from uniq where file_id % 10 = 0)) "
        "where source_file not in (select path from uniq where file_id % 15 = 0)"
    )
)
def ledger_touched_buckets(spark, d):
    """A stored ledger after two runs, each of which reads and writes only the buckets of its own keys."""
    book = LedgerTable.create(_ledger(spark, d), scratch_dir(spark, "ledger"), 64)
    some = _unique(spark, d).select("source_file", "file_id")
    book.apply(ledger.upsert, _news(spark, d).join(some.where("file_id % 10 = 0"), "source_file", "left_semi"), _now())
    book.apply(ledger.remove, some.where("file_id % 15 = 0").select("source_file"))
    return book.read()


# Text files


def _records(spark, d):
    return textlines.parse_lines(fixtures.text_files(spark, d))


_FLAT = "source_file, line_number, record_type, key, value, array_to_string(columns, '|') as columns, text"
_PAYLOAD = """case record_type
  when 'key_value' then '{"type":"key_value","line_number":' || line_number || ',"key":' || to_json(key) || ',"value":' || to_json(value) || '}'
  when 'csv_like' then '{"type":"csv_like","line_number":' || line_number || ',"columns":' || to_json(columns) || '}'
  else '{"type":"raw","line_number":' || line_number || ',"text":' || to_json(text) || '}' end as payload_json"""


@query(sql.text([sql.LINES], f"select {_FLAT} from fields"))
def parse_text_lines(spark, d):
    return _records(spark, d).withColumn("columns", F.array_join("columns", "|"))


@query(sql.text([sql.LINES], f"select source_file, line_number, record_type, {_PAYLOAD} from fields"))
def text_record_payload(spark, d):
    return textlines.with_payload(_records(spark, d))


@query(sql.text([sql.LINES], f"select source_file, line_number, record_type, {_PAYLOAD} from fields"))
def rubi_ledger_rows(spark, d):
    path = scratch_dir(spark, "records")
    textlines.with_payload(_records(spark, d)).write.parquet(path)
    return spark.read.parquet(path)


@query(
    sql.text(
        [sql.LINES],
        "select source_file, line_number, record_type, cast(nth as integer) as nth from (select *, row_number() over "
        "(partition by source_file order by line_number) as nth from fields) where nth <= 3",
    )
)
def text_preview_top3(spark, d):
    return textlines.preview(_records(spark, d)).select("source_file", "line_number", "record_type", "nth")


@query(
    sql.text(
        [sql.LINES],
        "select t.source_file, cast(length(t.text) as integer) as text_length, coalesce(n, 0) as n_records from text_files t left join "
        "(select source_file, count(*) as n from records group by all) using (source_file)",
    )
)
def text_file_stats(spark, d):
    return textlines.file_stats(fixtures.text_files(spark, d), _records(spark, d))


def _bodies(spark, d):
    return fixtures.text_files(spark, d).select("source_file", F.encode("text", "UTF-8").alias("content"))


@query(sql.text([], "select source_file, text from text_files"))
def decode_text(spark, d):
    return inventories.decode_bodies(_bodies(spark, d)).select("source_file", "text")


# The plain letters of a text with a Korean one behind them, whose two bytes are no UTF-8.
_OTHER = r"[^\x20-\x7E]"


@query(
    sql.text(
        [],
        f"select source_file, case when hash_ % 5 = 0 then regexp_replace(text, '{_OTHER}', '', 'g') || '가' else text end as text from "
        "(select *, length(text) as hash_ from text_files)",
    )
)
def decode_text_fallback(spark, d):
    plain = F.regexp_replace("text", _OTHER, "")
    other = F.concat(F.encode(plain, "UTF-8"), F.unhex(F.lit("B0A1")))
    bodies = fixtures.text_files(spark, d).select(
        "source_file", F.when(F.length("text") % 5 == 0, other).otherwise(F.encode("text", "UTF-8")).alias("content")
    )
    return inventories.decode_bodies(bodies).select("source_file", "text")


@query(sql.text([sql.LINES], f"select source_file, line_number, record_type, {_PAYLOAD} from fields"))
def rubi_pipeline(spark, d):
    return pipelines.text_pipeline(_bodies(spark, d))


# Pipelines over files

_IMAGE_RUN = f"""hit as (select u.path as source_file, t.path as matched_text_file, t.file_ts as matched_text_ts,
  cast(epoch(t.file_ts) - epoch(u.file_ts) as bigint) as matched_diff_seconds,
  row_number() over (partition by u.path order by t.file_ts, t.path, t.file_id) as r
  from uniq u join texts t on t.prefix = u.prefix and t.folder_date = u.folder_date and t.file_ts >= u.file_ts
    and t.file_ts <= u.file_ts + interval 5 minute),
best as (select *, {sql.action("source_file")} as action from hit where r = 1)"""


@query(
    sql.files(
        [*_BOOKS[:2], sql.PUBLISHED, sql.PREPARED, _IMAGE_RUN],
        f"""select u.path as source_file, u.prefix, u.file_ts as image_ts, b.matched_text_file, b.matched_text_ts, b.matched_diff_seconds,
  case when b.action = 'record' then {sql.output("u.path")} end as output_remote_file,
  case when l.source_file is null then {sql.NOW} else l.created_at end as created_at, {sql.NOW} as updated_at
from uniq u join best b on b.source_file = u.path left join ledger l on l.source_file = u.path""",
    )
)
def rupi_pipeline(spark, d):
    return pipelines.image_pipeline(
        fixtures.files(spark, d), _ledger(spark, d), _outputs(spark, d, 5), _outputs(spark, d, 7), _now()
    )


@query(
    sql.files(
        [sql.STACK, sql.PUBLISHED, sql.PREPARED],
        f"select text_id, text_path, image_id, image_path, diff_seconds, {sql.output('image_path')} as output_path, "
        f"case when image_id is null then 'store' else {sql.action('image_path')} end as action from exclusive",
    ).replace("from named where ok)", "from named where ok and folder_date in (date '2024-01-01', date '2024-01-02'))").replace(
        "texts as (select * from named where kind = 'text' and ok)",
        "texts as (select * from named where kind = 'text' and ok and folder_date in (date '2024-01-01', date '2024-01-02'))",
    )
)
def combined_pipeline(spark, d):
    plan = pipelines.combined_pipeline(fixtures.files(spark, d), ANCHOR, _outputs(spark, d, 5), _outputs(spark, d, 7))
    return plan.select("text_id", "text_path", "image_id", "image_path", "diff_seconds", "output_path", "action")


# Streams, run to the end of their input

#: Bytes of a micro-batch, and seconds of a slice that is one state: a state costs milliseconds of its own.
BATCH, STATE_SECONDS = 1 << 30, 86_400


@query(sql.query(_PARSED_EUV, f"select {sql.EUV_PARSED} from causes"))
def stream_root_causes(spark, d):
    source, target = scratch_dir(spark, "stream-in"), scratch_dir(spark, "stream-out")
    rows = _euv(spark, d)
    rows.write.parquet(source)
    logs_ = jobs.read_logs(spark, source, rows.schema, bytes_per_batch=BATCH)
    jobs.run_once(jobs.root_causes(logs_), target, scratch_dir(spark, "stream-state"))
    return spark.read.parquet(target)


@query(sql.raw([*sql.KEEP, *sql.SEED, sql.filled("filled", "kept", "seed")], "select * from filled"))
def stream_dose_warnings(spark, d):
    source, target = scratch_dir(spark, "stream-in"), scratch_dir(spark, "stream-out")
    rows, (first, last) = _scanned(spark, d), fixtures.WINDOW
    half = first + (last - first) / 2
    seed, checkpoint = scratch_dir(spark, "seed"), scratch_dir(spark, "stream-state")
    _seed(spark, d).write.parquet(seed)
    loads = [rows.where(F.col("code_occur_time") < F.lit(half)), rows.where(F.col("code_occur_time") >= F.lit(half))]
    # A load spans half the window, and so much later ones of its rows may come first.
    for load in [*loads, jobs.closing(spark, rows.schema, last + (last - first))]:
        jobs.write_logs(load, source)
        logs_ = jobs.read_logs(spark, source, rows.schema, files_per_batch=8)
        jobs.run_once(jobs.dose_warnings(logs_, spark.read.parquet(seed), delay="5 days"), target, checkpoint)
    return spark.read.parquet(target)


@query(
    sql.text(
        [],
        "select line, count(*) as n from (select unnest(string_split(text, chr(10))) as line from text_files) where line <> '' group by line",
    )
)
def stream_text_files(spark, d):
    """Files that come in two runs of one stream; each is read once."""
    source, target, state_ = (scratch_dir(spark, n) for n in ("texts-in", "texts-out", "texts-state"))
    texts = fixtures.text_files(spark, d)
    for part in (0, 1):
        texts.where(F.pmod(F.xxhash64("source_file"), F.lit(2)) == part).select("text").write.mode("append").text(source)
        jobs.run_once(jobs.text_bodies(spark, source), target, state_)
    lines = spark.read.parquet(target).select(F.explode(F.split("text", "\n", -1)).alias("line"))
    return lines.where("line <> ''").groupBy("line").agg(F.count(F.lit(1)).alias("n"))


@query(
    sql.text(
        [],
        "select line, count(*) as n from (select unnest(string_split(text, chr(10))) as line from text_files) where line <> '' group by line",
    )
)
def ingest_two_runs(spark, d):
    """Files of two runs, each micro-batch taken in exactly once and noted in a ledger."""
    source, target, state_ = (scratch_dir(spark, n) for n in ("ingest-in", "ingest-out", "ingest-state"))
    texts = fixtures.text_files(spark, d)
    lines = lambda bodies: bodies.select(F.explode(F.split("text", "\n", -1)).alias("line")).where("line <> ''")
    for part in (0, 1):
        texts.where(F.pmod(F.xxhash64("source_file"), F.lit(2)) == part).select("text").write.mode("append").text(source)
        ingest.ingest_once(jobs.text_bodies(spark, source, files_per_batch=4), target, state_, lines)
    return ingest.rows(spark, target).groupBy("line").agg(F.count(F.lit(1)).alias("n"))


def _stream_match(spark, d, match, asking: str, offered: str):
    """`match` over two streams of files, which come in two loads."""
    named = _stored(filenames.accepted(fixtures.files(spark, d)), "named")
    sides = [named.where(F.col("kind") == kind) for kind in (asking, offered)]
    first, last = sides[0].unionByName(sides[1]).agg(F.min("file_ts"), F.max("file_ts")).first()
    target, checkpoint = scratch_dir(spark, "match-out"), scratch_dir(spark, "match-state")
    sources = [scratch_dir(spark, "match-in") for _ in sides]
    half = first + (last - first) / 2
    # Files of a load come in any order, so the delay is what a load spans.
    delay = f"{int((last - half).total_seconds()) + 1} seconds"
    for before in (True, False):
        for side, source in zip(sides, sources, strict=True):
            load = side.where((F.col("file_ts") < F.lit(half)) == before).select("prefix", "folder_date", "file_id", "path", "file_ts")
            jobs.write_logs(load, source, time="file_ts")
            if not before:
                matches.closing_files(spark, load.schema, last + (last - first) + timedelta(days=1)).write.mode("append").parquet(source)
        streams = [jobs.read_logs(spark, source, load.schema, bytes_per_batch=BATCH) for source in sources]
        jobs.run_once(match(*streams, delay=delay, seconds=STATE_SECONDS), target, checkpoint)
    return spark.read.parquet(target)


@query(ORACLES["match_image_to_text"])
def stream_image_to_text(spark, d):
    return _stream_match(spark, d, matches.match_image_to_text, "image", "text")


@query(ORACLES["match_text_to_image"])
def stream_text_to_image(spark, d):
    return _stream_match(spark, d, matches.match_text_to_image, "text", "image")
