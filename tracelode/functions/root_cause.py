"""Rules of the root-cause reports and the columns of their parsed form."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelode.functions.text import (
    DECIMAL,
    FLAGS,
    INTEGER,
    FieldRule,
    normalize_contents,
    snake_code,
    strip,
)

# A report is told by this phrase and a label with a value.
GATE_PHRASE = "dose error detected in file:"
CAUSE = r"\broot\s+(?:cause|clause)\s*:\s*(.+)"

# Labels outside the fixed line form.
IDENTITY_RULES = (
    FieldRule("source_file_name", (r"\bdose\s+error\s+detected\s+in\s+file\s*:\s*(.+?)\s*\.?\s*$",), trim_period=True),
    FieldRule("source_exposure_id", (rf"\b(?:exposure\s+id|exposesue\s+i\s*d)\s*:\s*{INTEGER}",), "long"),
    FieldRule("source_code_occur_time", (r"\btime\s*:\s*([^\s]+)",), "time"),
    FieldRule("root_cause_message", (CAUSE,), trim_period=True),
    FieldRule("min_dose_error", (rf"\bmin\.\s*dose\s+error\s*:\s*{DECIMAL}",), "decimal"),
    FieldRule("max_dose_error", (rf"\bmax\.\s*dose\s+error\s*:\s*{DECIMAL}",), "decimal"),
    FieldRule("software_version", (r"\bsoftware\s+version\s*:\s*(.+)",), trim_period=True),
)

# Metric lines, label -> column.
METRICS = {
    "exposure length": "exposure_length",
    "duty cycle": "duty_cycle",
    "on drop euv energy": "on_drop_euv_energy",
    "on drop pp energy": "on_drop_pp_energy",
    "on drop mp energy": "on_drop_mp_energy",
    "on drop pp dlgc=1": "on_drop_pp_dlgc1",
    "on drop mp dlgc=1": "on_drop_mp_dlgc1",
    "bi-cell y 3sigma": "bi_cell_y_3sigma",
    "fdsc y error": "fdsc_y_error",
    "fdsc y 3sigma": "fdsc_y_3sigma",
    "max. cross. interval": "max_cross_interval",
    "xint 3sigma": "xint_3sigma",
    "euv 3sigma": "euv_3sigma",
    "l2dx maxce": "l2dx_maxce",
    "l2dy maxce": "l2dy_maxce",
    "sensitivity at l2dx maxce": "sensitivity_at_l2dx_maxce",
    "sensitivity at l2dy maxce": "sensitivity_at_l2dy_maxce",
    "dose margin": "dose_margin",
    "l2dx qc etdc 3sigma": "l2dx_qc_etdc_3sigma",
    "l2dx qc etdc median": "l2dx_qc_etdc_median",
    "l2dy qc etdc 3sigma": "l2dy_qc_etdc_3sigma",
    "l2dy qc etdc median": "l2dy_qc_etdc_median",
    "rbdy peak frequency hf": "rbdy_peak_frequency_hf",
    "rbdy peak frequency lf": "rbdy_peak_frequency_lf",
    "rbdy peak frequency mf": "rbdy_peak_frequency_mf",
    "rbdy peak power hf": "rbdy_peak_power_hf",
    "rbdy qc etdc 3sigma": "rbdy_qc_etdc_3sigma",
    "rbdy total power lf": "rbdy_total_power_lf",
    "rbdy total power mf": "rbdy_total_power_mf",
}
INTEGRAL_METRICS = {"pulses_euv<0.6dt_tot": "pulses_euv_lt_0_6dt_tot", "fed pulses": "fed_pulses"}


def line_pattern(label: str) -> str:
    """A metric: the label at the start of a line, a colon, a number; the unit behind is left out."""
    return rf"^{re.escape(label)}\s*:\s*{DECIMAL}"


METRIC_RULES = tuple(FieldRule(c, (line_pattern(label),), "decimal") for label, c in METRICS.items())
INTEGRAL_RULES = tuple(FieldRule(c, (line_pattern(label),), "integral") for label, c in INTEGRAL_METRICS.items())

SOURCE_COLUMNS = (
    "er_line", "eq_name", "er_type", "code", "code_occur_time", "belong", "type", "title", "contents",
    "reason_code", "task", "compile_script",
)
# The result table's columns, in its order.
PARSED_COLUMNS = (
    "er_line", "eq_name", "er_type", "code", "code_occur_time", "belong", "type", "title", "contents", "reason_code", "task",
    "compile_script", "source_exposure_id", "source_code_occur_time", "dose_error", "source_file_name", "root_cause_code",
    "root_cause_message", "exposure_length", "duty_cycle", "min_dose_error", "max_dose_error", "on_drop_euv_energy",
    "on_drop_pp_energy", "on_drop_mp_energy", "on_drop_pp_dlgc1", "on_drop_mp_dlgc1", "bi_cell_y_3sigma", "fdsc_y_error",
    "fdsc_y_3sigma", "max_cross_interval", "xint_3sigma", "euv_3sigma", "pulses_euv_lt_0_6dt_tot", "fed_pulses", "l2dx_maxce",
    "l2dy_maxce", "sensitivity_at_l2dx_maxce", "sensitivity_at_l2dy_maxce", "dose_margin", "l2dx_qc_etdc_3sigma",
    "l2dx_qc_etdc_median", "l2dy_qc_etdc_3sigma", "l2dy_qc_etdc_median", "rbdy_peak_frequency_hf", "rbdy_peak_frequency_lf",
    "rbdy_peak_frequency_mf", "rbdy_peak_power_hf", "rbdy_qc_etdc_3sigma", "rbdy_total_power_lf", "rbdy_total_power_mf",
    "software_version",
)
INTEGER_COLUMNS = {"source_exposure_id": "long", "pulses_euv_lt_0_6dt_tot": "int", "fed_pulses": "int"}


def is_root_cause(text: Column) -> Column:
    """Whether normalised contents are a root-cause report."""
    cause = F.regexp_extract(text, FLAGS + CAUSE, 1)
    return F.coalesce(F.lower(text).contains(GATE_PHRASE) & (strip(cause) != ""), F.lit(False))


def dominant_dose_error(least: Column, most: Column) -> Column:
    """The one of larger absolute value, the first on a tie; the other where one is null."""
    return F.when(most.isNull() | (F.abs(least) >= F.abs(most)), least).otherwise(most)


RULES = (*IDENTITY_RULES, *METRIC_RULES, *INTEGRAL_RULES)
#: What may stand behind a label's colon for a field of a kind; all others are numbers.
_VALUES = {"text": ".+", "time": r"[^\s]+"}
_NUMBER = r"[+-]?\d+(?:\.\d+)?"
_BLANK = " \t\n\x0b\f\r"
#: Labels of identity fields as they are written, blanks left out; the second is the first misspelt.
_WRITTEN = {
    "source_file_name": ("doseerrordetectedinfile",),
    "source_exposure_id": ("exposureid", "exposesueid"),
    "source_code_occur_time": ("time",),
    "root_cause_message": ("rootcause", "rootclause"),
    "min_dose_error": ("min.doseerror",),
    "max_dose_error": ("max.doseerror",),
    "software_version": ("softwareversion",),
}
_LABELS = {
    **{name: written[0] for name, written in _WRITTEN.items()},
    **{column: label.replace(" ", "") for label, column in (METRICS | INTEGRAL_METRICS).items()},
}


def _entry_pattern() -> str:
    """Every place where a label with a value that fits its kind starts; the entry is looked at and not taken, so that one
    entry's text hides no other. Where a label may start is asked once for all of them."""
    starts: dict[str, dict[str, list[str]]] = {}
    for rule in RULES:
        label = rule.patterns[0].split(r"\s*:\s*")[0]
        start = "^" if label[0] == "^" else r"\b"
        starts.setdefault(start, {}).setdefault(_VALUES.get(rule.kind, _NUMBER), []).append(label.removeprefix(start))
    entry = lambda found: "|".join(rf"(?:{'|'.join(labels)})\s*:\s*{value}" for value, labels in found.items())
    return "(?=(" + "|".join(f"{start}(?:{entry(found)})" for start, found in starts.items()) + "))"


ENTRY = _entry_pattern()


def with_fields(rows: DataFrame, text: str, rules: tuple[FieldRule, ...] = RULES, *, instants: bool = False) -> DataFrame:
    """`rows` with the columns of `rules`, from one pass over column `text`. The pass gives the report's entries, labels
    with their values; a rule then looks at the first entry of its label, as if it had searched the whole text by
    itself. An empty label takes the next line's text. With `instants` also source_code_occur_instant."""
    entries = rows.withColumn("_entries", F.regexp_extract_all(text, F.lit(FLAGS + ENTRY), F.lit(1)))

    def label(entry: Column) -> Column:
        name = F.translate(F.lower(F.split_part(entry, F.lit(":"), F.lit(1))), _BLANK, "")
        for right, *others in _WRITTEN.values():
            for other in others:
                name = F.replace(name, F.lit(other), F.lit(right))
        return name

    # One step looks all labels up: a search for each column would be code that is too long to be compiled. Names are bound
    # by an array of one, so that they are worked out once and not for each label.
    wanted = [*dict.fromkeys([rule.name for rule in rules] + ["source_code_occur_time"] * instants)]
    labels = F.array(*[F.lit(_LABELS[name]) for name in wanted])
    first = lambda names: lambda x: F.get("_entries", (F.array_position(names, x) - 1).cast("int"))
    bound = F.transform(F.array(F.transform("_entries", label)), lambda names: F.transform(labels, first(names)))
    named = entries.withColumn("_found", F.get(bound, F.lit(0)))
    of = lambda name: F.get("_found", F.lit(wanted.index(name)))
    found = [rule.column(of(rule.name)) for rule in rules]
    if instants:
        found.append(instant(of("source_code_occur_time")).alias("source_code_occur_instant"))
    return named.select("*", *found).drop("_entries", "_found")


def instant(text: Column) -> Column:
    """The instant of the first time entry of `text`; null where it has no offset, as it is then not known."""
    (rule,) = (r for r in IDENTITY_RULES if r.kind == "time")
    value = F.upper(F.regexp_extract(text, FLAGS + rule.patterns[0], 1))
    return F.when(value.rlike(r":\d\d(\.\d+)?(Z|[+-]\d\d:\d\d)\z"), value).try_cast("timestamp")


def parse_root_causes(logs: DataFrame, *, instants: bool = False) -> DataFrame:
    """Root-cause reports among `logs` with all parsed columns; other rows (and null contents) go.
    The normalised text is worked out once, before the rules. Times are wall-clock times as the table has them; with
    `instants` a further column source_code_occur_instant keeps their offset."""
    text = F.col("_text")
    whole = normalize_contents(F.coalesce(F.col("contents"), F.lit(""))).alias("_text")
    # The gate reads the text several times. It is not moved past a column that is not deterministic, to where each of these
    # would work the text out again.
    kept = logs.select(*SOURCE_COLUMNS, whole, F.spark_partition_id().alias("_part")).where((F.col("_part") >= 0) & is_root_cause(text))
    parsed = with_fields(kept, "_text", instants=instants)
    return parsed.select(
        "*",
        snake_code(F.col("root_cause_message")).alias("root_cause_code"),
        dominant_dose_error(F.col("min_dose_error"), F.col("max_dose_error")).alias("dose_error"),
    ).select(*PARSED_COLUMNS, *["source_code_occur_instant"] * instants)
