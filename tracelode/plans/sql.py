"""DuckDB SQL for the results of the registered queries, built from the same rules."""

from __future__ import annotations

from tracelode.functions import dose, root_cause
from tracelode.functions.text import FieldRule
from tracelode.plans.fixtures import ER_RAW, EUV_RAW, FILES, SEED_WINDOW, TEXT_FILES, WINDOW

# RE2 spells the same classes; its \s lacks VT, which no fixture holds.
BLANK = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
LINE_END = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]"
ORDER = "code_occur_time, er_date, er_index, er_line, code, contents"
SOURCE = ", ".join(dose.SOURCE_COLUMNS)
PARSED = ", ".join(dose.PARSED_COLUMNS)


def ts(value) -> str:
    return f"timestamp '{value}'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{BLANK}+|{BLANK}+$', '', 'g')"


def strip_trailing_period(x: str) -> str:
    return f"nullif({strip(f'''regexp_replace({strip(x)}, '[.]$', '')''')}, '')"


def group(text: str, pattern: str) -> str:
    return f"nullif(regexp_extract({text}, '(?im){pattern}', 1), '')"


def typed(rule: FieldRule, value: str) -> str:
    if rule.kind == "text":
        return strip_trailing_period(value) if rule.trim_period else f"nullif({strip(value)}, '')"
    if rule.kind == "time":
        return f"try_cast(left(upper({value}), 26) as timestamp)"
    if rule.kind == "integral":
        exact = f"try_cast({value} as decimal(38,18))"
        return f"case when {exact} = floor({exact}) then try_cast({exact} as integer) end"
    return f"try_cast({value} as {({'int': 'integer', 'long': 'bigint', 'decimal': 'decimal(12,7)'})[rule.kind]})"


def field(rule: FieldRule, text: str) -> str:
    found = [typed(rule, group(text, p)) for p in rule.patterns]
    if rule.minimum is not None:
        found = [f"case when {v} >= {rule.minimum} then {v} end" for v in found]
    return f"coalesce({', '.join(found)}, null)"


def scan(name: str, window) -> str:
    codes = ", ".join(f"'{c}'" for c in dose.TARGET_CODES)
    return f"""{name} as (select {SOURCE} from er_raw where code_occur_time >= {ts(window[0])} and code_occur_time < {ts(window[1])}
  and code in ({codes}))"""


def parse(name: str, source: str) -> str:
    text = "coalesce(contents, '')"

    def only(rules, families):
        return [f"case when {families} then {field(r, text)} end as {r.name}" for r in rules]

    dw, both = "starts_with(code, 'DW-')", "(starts_with(code, 'DW-') or starts_with(code, 'LO-'))"
    columns = [*only(dose.HANDLE_RULES, dw), *only(dose.WAFER_RULES, both), *only(dose.ERROR_RULES, dw)]
    return f"{name} as (select {SOURCE}, {', '.join(columns)} from {source})"


def unfit_values(code: str, text: str) -> str:
    """Numbers of a message whose type does not hold them."""
    dw, both = f"starts_with({code}, 'DW-')", f"(starts_with({code}, 'DW-') or starts_with({code}, 'LO-'))"

    def one(rule: FieldRule, families: str) -> str:
        found = " or ".join(f"({group(text, p)} is not null and {typed(rule, group(text, p))} is null)" for p in rule.patterns)
        return f"case when {families} and ({found}) then 1 else 0 end"

    every = [*[one(r, dw) for r in (*dose.HANDLE_RULES, *dose.ERROR_RULES)], *[one(r, both) for r in dose.WAFER_RULES]]
    return " + ".join(every)


COUNTED = "(eq_name is not null and starts_with(upper(code), 'DW-') and exposure_handle is not null)"


def lagged(name: str, source: str) -> str:
    return f"""{name} as (select *, case when {COUNTED} then last_value(case when {COUNTED} then exposure_handle end ignore nulls)
  over (partition by eq_name order by {ORDER} rows between unbounded preceding and 1 preceding) end as previous_handle from {source})"""


def kept(name: str, source: str) -> str:
    return f"{name} as (select {PARSED} from {source} where not coalesce(exposure_handle - previous_handle >= 1000, false))"


def filled(name: str, source: str, seed: str | None = None) -> str:
    def one(c: str) -> str:
        carried = f"last_value({c} ignore nulls) over (partition by p.eq_name order by {ORDER} rows between unbounded preceding and current row)"
        start = f"coalesce({carried}, s.seed_{c})" if seed else carried
        return f"coalesce({c}, case when p.eq_name is not null then {start} end) as {c}"

    columns = ", ".join(one(c) if c in ("wafer_id", "wafer_seq") else f"p.{c}" for c in dose.PARSED_COLUMNS)
    join = f"left join (select eq_name as seed_eq, wafer_id as seed_wafer_id, wafer_seq as seed_wafer_seq from {seed}) s on p.eq_name = s.seed_eq" if seed else ""
    return f"{name} as (select {columns} from {source} p {join})"


def latest(name: str, source: str) -> str:
    return f"""{name} as (select eq_name, wafer_id, wafer_seq from (select *, row_number() over (partition by eq_name
  order by code_occur_time desc, er_date desc, er_index desc) as r from {source}
  where eq_name is not null and (wafer_id is not null or wafer_seq is not null)) where r = 1)"""


SEED = [scan("seed_scan", SEED_WINDOW), parse("seed_parsed", "seed_scan"), lagged("seed_lag", "seed_parsed"),
        kept("seed_kept", "seed_lag"), filled("seed_rows", "seed_kept"), latest("seed", "seed_rows")]
PARSE = [scan("scanned", WINDOW), parse("parsed", "scanned")]
LAG = [*PARSE, lagged("lagged", "parsed")]
KEEP = [*LAG, kept("kept", "lagged")]
PIPELINE = [*KEEP, *SEED, filled("filled", "kept", "seed"), f"result as (select distinct {PARSED} from filled)"]


def query(ctes, select: str) -> str:
    return "with " + ",\n".join(ctes) + "\n" + select


def raw(ctes, select: str) -> str:
    return query([ER_RAW, *ctes], select)


NORMAL = strip("replace(coalesce(contents, ''), '\\n', chr(10))")
CAUSE = root_cause.CAUSE
GATE = f"""contains(lower(t), '{root_cause.GATE_PHRASE}') and regexp_matches(t, '(?im){CAUSE}')
  and coalesce({strip(group("t", CAUSE))} <> '', false)"""
EUV_SOURCE = ", ".join(root_cause.SOURCE_COLUMNS)
EUV_SCAN = f"""scanned as (select {EUV_SOURCE} from euv_raw where code_occur_time >= {ts(WINDOW[0])} and code_occur_time < {ts(WINDOW[1])})"""
NORMALIZED = f"normalized as (select *, {NORMAL} as t from scanned)"
GATED = f"gated as (select * from normalized where {GATE})"
FIELDS = ", ".join(
    f"{field(r, 't')} as {r.name}" for r in (*root_cause.IDENTITY_RULES, *root_cause.METRIC_RULES, *root_cause.INTEGRAL_RULES)
)
SNAKE = "nullif(regexp_replace(regexp_replace(lower({x}), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), '')"
CAUSES = f"""causes as (select *, {SNAKE.format(x="root_cause_message")} as root_cause_code,
  case when max_dose_error is null or abs(min_dose_error) >= abs(max_dose_error) then min_dose_error else max_dose_error end as dose_error
  from (select {EUV_SOURCE}, {FIELDS} from gated))"""
EUV = [EUV_RAW, EUV_SCAN, NORMALIZED]
EUV_PARSED = ", ".join(root_cause.PARSED_COLUMNS)


def files(ctes, select: str) -> str:
    return query([FILES, *ctes], select)


# Nearest matches by joining on the reach, independent of the windows that the operators use.
FORWARD = """forward as (select i.prefix, i.folder_date, i.file_id as image_id, i.path as image_path, i.file_ts as image_ts,
  t.file_id as text_id, t.path as text_path, t.file_ts as text_ts,
  cast(epoch(t.file_ts) - epoch(i.file_ts) as bigint) as diff_seconds,
  row_number() over (partition by i.file_id order by t.file_ts, t.path, t.file_id) as r
  from images i join texts t on t.prefix = i.prefix and t.folder_date = i.folder_date and t.file_ts >= i.file_ts
    and t.file_ts <= i.file_ts + interval 5 minute)"""
BACKWARD = """backward as (select t.prefix, t.file_id as text_id, t.path as text_path, t.file_ts as text_ts,
  i.file_id as image_id, i.path as image_path, i.file_ts as image_ts,
  cast(epoch(t.file_ts) - epoch(i.file_ts) as bigint) as diff_seconds,
  row_number() over (partition by t.file_id order by i.file_ts desc, i.path, i.file_id) as r
  from texts t join images i on t.prefix = i.prefix and i.file_ts <= t.file_ts and i.file_ts >= t.file_ts - interval 5 minute)"""
# The stack of the exclusive match, by one running sum for each prefix.
STACK = """seq as (select kind, prefix, file_id, path, file_ts, row_number() over (partition by prefix order by file_ts,
    case kind when 'image' then 0 else 1 end, case kind when 'image' then -nth else nth end) as n
  from (select *, row_number() over (partition by prefix, file_ts, kind order by path, file_id) as nth from named where ok)),
run as (select *, sum(case kind when 'image' then 1 else -1 end) over (partition by prefix order by n) as s from seq),
low as (select *, least(0, min(s) over (partition by prefix order by n)) as m,
  least(0, coalesce(min(s) over (partition by prefix order by n rows between unbounded preceding and 1 preceding), 0)) as was from run),
lev as (select *, s - m + case kind when 'text' then 1 else 0 end as level from low where not (kind = 'text' and s < was)),
pop as (select *, lag(kind) over w as k, lag(file_id) over w as image_id, lag(path) over w as image_path, lag(file_ts) over w as image_ts
  from lev window w as (partition by prefix, level order by n)),
pairs as (select file_id as text_id, image_id, image_path, image_ts, cast(epoch(file_ts) - epoch(image_ts) as bigint) as diff_seconds
  from pop where kind = 'text' and k = 'image' and epoch(file_ts) - epoch(image_ts) <= 300),
exclusive as (select t.prefix, t.file_id as text_id, t.path as text_path, t.file_ts as text_ts, p.image_id, p.image_path, p.image_ts,
  p.diff_seconds from texts t left join pairs p on t.file_id = p.text_id)"""


# The exclusive match as a loop: of each prefix one text after another takes the nearest free image.
GREEDY = f"""with recursive {FILES},
queue as (select *, row_number() over (partition by prefix order by file_ts, path, file_id) as k from texts),
near as (select t.prefix, t.k, i.file_id, i.path, i.file_ts,
  row_number() over (partition by t.prefix, t.k order by i.file_ts desc, i.path, i.file_id) as choice
  from queue t join images i on i.prefix = t.prefix and i.file_ts <= t.file_ts and i.file_ts >= t.file_ts - interval 5 minute),
loop as (
  select prefix, 0::bigint as k, []::bigint[] as used, null::bigint as image_id from queue where k = 1
  union all
  (with best as (select l.prefix, arg_min(n.file_id, n.choice) as image_id from loop l join near n on n.prefix = l.prefix and n.k = l.k + 1
      where not list_contains(l.used, n.file_id) group by l.prefix)
  select l.prefix, l.k + 1, case when b.image_id is null then l.used else list_append(l.used, b.image_id) end, b.image_id
  from loop l join queue q on q.prefix = l.prefix and q.k = l.k + 1 left join best b on b.prefix = l.prefix))
select q.prefix, q.file_id as text_id, q.path as text_path, q.file_ts as text_ts, l.image_id, n.path as image_path, n.file_ts as image_ts,
  cast(epoch(q.file_ts) - epoch(n.file_ts) as bigint) as diff_seconds
from queue q join loop l on l.prefix = q.prefix and l.k = q.k left join near n on n.prefix = q.prefix and n.k = q.k and n.file_id = l.image_id"""


def output(path: str) -> str:
    return f"'rbi/ruip' || regexp_replace(regexp_extract({path}, '(?i)/ruip(/.*)$', 1), '[.][^./]*$', '') || '.png'"


PUBLISHED = f"published as (select distinct {output('path')} as output_path from images where file_id % 5 = 0)"
PREPARED = f"prepared as (select distinct {output('path')} as output_path from images where file_id % 7 = 0)"


def action(path: str) -> str:
    return f"""case when {output(path)} in (select output_path from published) then 'record'
  when {output(path)} in (select output_path from prepared) then 'reuse' else 'convert' end"""


LINES = f"""lines as (select source_file, n as line_number, {strip("parts[n]")} as line
  from (select source_file, parts, unnest(range(1, len(parts) + 1)) as n
    from (select source_file, regexp_split_to_array(text, '{LINE_END}') as parts from text_files))),
records as (select source_file, cast(line_number as integer) as line_number,
  case when contains(line, '=') then 'key_value' when contains(line, ',') then 'csv_like' else 'raw' end as record_type, line
  from lines where line <> ''),
fields as (select source_file, line_number, record_type,
  case when record_type = 'key_value' then {strip("left(line, instr(line, '=') - 1)")} end as key,
  case when record_type = 'key_value' then {strip("line[instr(line, '=') + 1:]")} end as value,
  case when record_type = 'csv_like' then list_transform(string_split(line, ','), lambda x: {strip("x")}) end as columns,
  case when record_type = 'raw' then line end as text from records)"""


def text(ctes, select: str) -> str:
    return query([TEXT_FILES, *ctes], select)


# The ledger that the ledger queries start from, and their time of change.
NOW = "timestamp '2024-02-01 00:00:00'"
THEN = "timestamp '2024-01-01 00:00:00'"
UNIQUE = "uniq as (select path, min_by(file_id, file_id) as file_id, min_by(prefix, file_id) as prefix, min_by(file_ts, file_id) as file_ts, min_by(folder_date, file_id) as folder_date from images group by path)"
LEDGER = f"""ledger as (select path as source_file, prefix, file_ts as image_ts, 'old.txt' as matched_text_file,
  file_ts as matched_text_ts, 0::bigint as matched_diff_seconds, cast(null as varchar) as output_remote_file,
  {THEN} as created_at, cast(null as timestamp) as updated_at from uniq where file_id % 3 = 0)"""
LEDGER_COLUMNS = "source_file, prefix, image_ts, matched_text_file, matched_text_ts, matched_diff_seconds, output_remote_file, created_at, updated_at"
NEWS = f"""news as (select path as source_file, prefix, file_ts as image_ts, 'new.txt' as matched_text_file,
  file_ts + interval 60 second as matched_text_ts, 60::bigint as matched_diff_seconds, {output("path")} as output_remote_file
  from uniq where file_id % 2 = 0)"""
