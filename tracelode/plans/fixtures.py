"""The library's input shapes derived from the event and document tables, as DataFrames and as SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WINDOW = (datetime(2024, 1, 10), datetime(2024, 1, 20))
SEED_WINDOW = (datetime(2024, 1, 9), datetime(2024, 1, 10))
CLOCK = "2024-01-01 23:00:00"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", F.expr("cast(value as decimal(12,2)) as v"))


def _spread(events: DataFrame) -> DataFrame:
    """`events` dealt over all cores while they are narrow: texts and names are made of them and read again behind that, at
    many times the work of a scan, which is as many tasks only as its files have row groups."""
    dealt = events.repartition(4 * events.sparkSession.sparkContext.defaultParallelism, "event_id")
    # Always true, and not deterministic: filters on texts are not moved through it to the scan's few tasks.
    return dealt.where(F.spark_partition_id() >= 0)


_HANDLE = "(event_id * 3 + {div} * 1500)"


def _code(case_of) -> str:
    """CASE of the message code; `case_of(list, n)` picks by event_id % n."""
    return f"""case event_type when 'error' then {case_of(('DW-3411', 'DW-3425', 'DW-343A', 'DW-343B'))}
  when 'click' then {case_of(('LO-0061', 'LO-8166', 'LO-8167'))} when 'view' then {case_of(('KE-9103', 'KE-9104'))}
  when 'signup' then 'XX-0001' else 'dw-3411' end"""


def _pick(options) -> str:
    n = len(options)
    return f"case event_id % {n} " + " ".join(f"when {i} then '{o}'" for i, o in enumerate(options)) + " end"


def _contents(handle: str, text: str, newline: str) -> str:
    """The message text; every number is turned to text from whole numbers or decimals."""
    s = lambda x: f"cast({x} as {text})"
    return f"""case when event_id % 101 = 0 then null
  when event_type in ('error', 'purchase') then
    case when event_id % 10 = 0 then 'min_de_error=-' else 'de_err=' end || {s('v')} || ' [%] de_warn_lvl=0 [%]' || {newline} ||
    'freq=50000 [hz] n_slit=' || {s('event_id % 64')} || ' action_handle=' || {s(handle + ' - 6')} ||
    case when event_id % 7 = 0 then '' else ' exposure_handle:' || {s(handle)} end ||
    case when event_id % 9 = 0 then ' wafer_id=' || {s('event_id % 50')} else '' end
  when event_type = 'click' and event_id % 3 = 0 then 'loading reticle ''r1'' for lot id ' || {s('1000 + event_id % 900')} || '.'
  when event_type = 'click' then 'expose image(0) of production wafer(' || {s('event_id % 26')} || ') for lot(' || {s('1000 + event_id % 900')} || ') started on chuck(c1)'
  when event_type = 'view' then 'die re-exposures have started.'
  else 'system info: normal message' end"""


def er_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dose-warning source log, one row for each event."""
    handle = _HANDLE.format(div="(event_id div 700)")
    return _events(spark, sf_dir).selectExpr(
        "cast(date_format(ts, 'yyyyMMdd') as int) as er_date",
        "cast(event_id as int) as er_index",
        "'L' || cast(user_id % 3 + 1 as string) as er_line",
        "case when event_id % 97 = 0 then null else 'EQ' || cast(user_id % 12 as string) end as eq_name",
        _code(_pick) + " as code",
        "ts as code_occur_time",
        "'SCANNER' as belong",
        "'ER' as type",
        "'Dose warning' as title",
        _contents(handle, "string", "'\\n'") + " as contents",
    )


ER_RAW = f"""er_raw as (select cast(strftime(ts, '%Y%m%d') as integer) as er_date, cast(event_id as integer) as er_index,
  'L' || cast(user_id % 3 + 1 as varchar) as er_line,
  case when event_id % 97 = 0 then null else 'EQ' || cast(user_id % 12 as varchar) end as eq_name,
  {_code(_pick)} as code, ts as code_occur_time, 'SCANNER' as belong, 'ER' as type, 'Dose warning' as title,
  {_contents(_HANDLE.format(div="(event_id // 700)"), "varchar", "chr(10)")} as contents
  from (select event_id, ts, user_id, event_type, cast(value as decimal(12,2)) as v from events))"""


#: Metric labels in the order in which the reports list them.
LABELS = (
    "Exposure length", "Duty cycle", "On drop EUV energy", "On drop PP energy", "On drop MP energy", "On drop PP dlgc=1",
    "On drop MP dlgc=1", "Bi-cell Y 3sigma", "FDSC Y error", "FDSC Y 3sigma", "Max. cross. interval", "Xint 3sigma",
    "EUV 3sigma", "L2Dx maxce", "L2Dy maxce", "Sensitivity at L2Dx maxce", "Sensitivity at L2Dy maxce", "Dose margin",
    "L2Dx QC ETDC 3sigma", "L2Dx QC ETDC median", "L2Dy QC ETDC 3sigma", "L2Dy QC ETDC median", "RBDy peak frequency HF",
    "RBDy peak frequency LF", "RBDy peak frequency MF", "RBDy peak power HF", "RBDy QC ETDC 3sigma", "RBDy total power LF",
    "RBDy total power MF",
)


def _report(text: str, div: str, iso: str) -> str:
    """A report's lines joined by `sep`."""
    s = lambda x: f"cast({x} as {text})"
    dec = lambda x: s(f"cast({x} as decimal(12,2))")
    lines = [
        "'Dose error detected in file: report_' || " + s("event_id") + " || '.zip.'",
        "case when event_id % 3 = 0 then 'Note' when event_id % 5 = 0 then 'Root clause' else 'Root cause' end || ' : ' || "
        "case event_id % 4 when 0 then 'plasma oscillations' when 1 then 'Low dose margin.' when 2 then 'X-int / drift' else '' end",
        "case when event_id % 5 = 0 then 'Exposesue I D' else 'Exposure ID' end || ' : ' || " + s("event_id"),
        f"'Time : ' || case when event_id % 2 = 0 then lower({iso}) else {iso} end || '+09:00'",
        "'Min. dose error : ' || " + dec("-(v * 0.1)") + " || ' [perc]'",
        "'Max. dose error : ' || " + dec("(event_id % 7) - v * 0.05") + " || ' [perc]'",
    ]
    for k, label in enumerate(LABELS, 1):
        line = f"'{label} : ' || " + s(f"cast(v * {k} + event_id % 10 as decimal(12,4))") + " || ' [u]'"
        lines.append(f"case when event_id % 11 = 0 then 'skipped' else {line} end" if label == "Duty cycle" else line)
    lines.append("'Pulses_EUV<0.6DT_tot : ' || " + s("event_id % 500") + " || ' [pulsecount]'")
    lines.append(
        "'FED pulses : ' || " + s("event_id % 200") + f" || case {div} % 3 when 0 then '' when 1 then '.0' else '.5' end || ' [pulsecount]'"
    )
    lines.append("'Software version : ' || " + s("event_id % 5") + " || '.0 [nxe]'")
    return " || sep || ".join(f"({x})" for x in lines)


_EUV_COLUMNS = """'L' || cast(user_id % 3 + 1 as {text}) as er_line, 'EQ' || cast(user_id % 12 as {text}) as eq_name,
  'ER' as er_type, 'EU-' || cast(event_id % 9 as {text}) as code, ts as code_occur_time, 'SCANNER' as belong, 'ER' as type,
  'Root cause' as title, {report} as contents, 'R' || cast(event_id % 4 as {text}) as reason_code, 'task' as task,
  cast(null as {text}) as compile_script"""


def euv_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Root-cause source log, one row for each event of two types."""
    _spread(_events(spark, sf_dir).where("event_type in ('error', 'purchase')")).createOrReplaceTempView("_euv_events")
    iso = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"
    report = _report("string", "(event_id div 3)", iso)
    sep = "case when event_id % 2 = 0 then '\\\\n' else '\\n' end"
    return spark.sql(f"select {_EUV_COLUMNS.format(text='string', report=report)} from (select *, {sep} as sep from _euv_events)")


EUV_RAW = f"""euv_raw as (select {_EUV_COLUMNS.format(text="varchar", report=_report("varchar", "(event_id // 3)", "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"))}
  from (select event_id, ts, user_id, event_type, cast(value as decimal(12,2)) as v,
    case when event_id % 2 = 0 then '\\n' else chr(10) end as sep from events where event_type in ('error', 'purchase')))"""


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory of texts and images on a compressed clock."""
    clock = f"timestamp_ntz'{CLOCK}' + make_dt_interval(0, 0, 0, event_id * 7 + (event_id * 13) % 40)"
    name = "'p' || cast(user_id % 3 as string) || '_' || date_format(ts, 'yyyyMMdd_HHmmss')"
    return (
        _spread(_events(spark, sf_dir).where("event_type in ('view', 'click')").select("event_id", "user_id", "event_type"))
        .selectExpr("event_id", "user_id", "event_type", f"{clock} as ts")
        .selectExpr(
            "event_id as file_id",
            "case event_type when 'view' then 'image' else 'text' end as kind",
            "to_date(ts) as folder_date",
            f"case event_type when 'view' then '/RUIP/' else '/RUBI/' end || date_format(ts, 'yyyyMMdd') || '/' || "
            f"case when event_id % 89 = 0 then 'bad' else {name} end || case event_type when 'view' then '.tif' else '.txt' end as path",
            "cast(event_id % 1000 as long) as size",
            "ts as modified",
        )
    )


FILES = f"""files as (select event_id as file_id, case event_type when 'view' then 'image' else 'text' end as kind,
  cast(ts as date) as folder_date,
  case event_type when 'view' then '/RUIP/' else '/RUBI/' end || strftime(ts, '%Y%m%d') || '/' ||
  case when event_id % 89 = 0 then 'bad' else 'p' || cast(user_id % 3 as varchar) || '_' || strftime(ts, '%Y%m%d_%H%M%S') end ||
  case event_type when 'view' then '.tif' else '.txt' end as path, cast(event_id % 1000 as bigint) as size, ts as modified
  from (select event_id, user_id, event_type, timestamp '{CLOCK}' + to_seconds(event_id * 7 + (event_id * 13) % 40) as ts
    from events where event_type in ('view', 'click'))),
named as (select *, case when ok then regexp_extract(path, '([^/]+)_\\d{{8}}_\\d{{6}}\\.[a-z]+$', 1) end as prefix,
  case when ok then strptime(replace(regexp_extract(path, '_(\\d{{8}}_\\d{{6}})\\.[a-z]+$', 1), '_', ''), '%Y%m%d%H%M%S') end as file_ts
  from (select *, regexp_matches(path, '_\\d{{8}}_\\d{{6}}\\.[a-z]+$') as ok from files)),
images as (select * from named where kind = 'image' and ok), texts as (select * from named where kind = 'text' and ok)"""


def text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text bodies; colons become equals signs in every second document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.selectExpr(
        "'/RUBI/' || cast(doc_id as string) || '.txt' as source_file",
        "case when doc_id % 2 = 0 then replace(text, ':', '=') else text end as text",
    )


TEXT_FILES = """text_files as (select '/RUBI/' || cast(doc_id as varchar) || '.txt' as source_file,
  case when doc_id % 2 = 0 then replace(text, ':', '=') else text end as text from documents)"""
