"""Rules of the dose-warning messages and the columns of their parsed form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelode.functions.text import DECIMAL, INTEGER, FieldRule, extract

# Message codes that are read, by family.
DOSE_CODES = ("DW-3411", "DW-3425", "DW-343A", "DW-343B")
LOT_CODES = ("LO-0061", "LO-8166", "LO-8167")
KEY_CODES = ("KE-9103", "KE-9104")
TARGET_CODES = DOSE_CODES + LOT_CODES + KEY_CODES

# Where each field stands in a message.
HANDLE_RULES = (
    FieldRule("exposure_handle", (rf"exposure_handle\s*[:=]\s*{INTEGER}",), "long"),
    FieldRule("action_handle", (rf"action_handle\s*[:=]\s*{INTEGER}",), "long"),
)
WAFER_RULES = (
    FieldRule(
        "wafer_id",
        (
            rf"lot\(\s*{INTEGER}\s*\)",
            rf"lot id\s+{INTEGER}",
            rf"wafer_id\s*[:=]\s*{INTEGER}",
            rf"wafer id\s*[:=]\s*{INTEGER}",
        ),
        "int",
        minimum=1,
    ),
    FieldRule(
        "wafer_seq",
        (
            rf"wafer\(\s*{INTEGER}\s*\)",
            rf"wafer_seq\s*[:=]\s*{INTEGER}",
            rf"wafer seq\s*[:=]\s*{INTEGER}",
            rf"slot_seq\s*[:=]\s*{INTEGER}",
            rf"slot seq\s*[:=]\s*{INTEGER}",
        ),
        "int",
        minimum=1,
    ),
)
ERROR_RULES = (
    FieldRule("de_err", (rf"de_err\s*[:=]\s*{DECIMAL}", rf"min_de_error\s*[:=]\s*{DECIMAL}"), "decimal"),
    FieldRule("n_slit", (rf"n_slit\s*[:=]\s*{INTEGER}",), "int"),
)

SOURCE_COLUMNS = (
    "er_date", "er_index", "er_line", "eq_name", "code", "code_occur_time", "belong", "type", "title", "contents",
)
PARSED_COLUMNS = (*SOURCE_COLUMNS, "exposure_handle", "action_handle", "wafer_id", "wafer_seq", "de_err", "n_slit")
INTEGER_COLUMNS = {
    "er_date": "int", "er_index": "int", "exposure_handle": "long", "action_handle": "long",
    "wafer_id": "int", "wafer_seq": "int", "n_slit": "int",
}


def code_family(code: Column) -> Column:
    """DW or LO by case-sensitive prefix, other codes (and null) as other."""
    return F.when(code.startswith("DW-"), "DW").when(code.startswith("LO-"), "LO").otherwise("other")


def parse_dose_warnings(logs: DataFrame, *carried: str) -> DataFrame:
    """Source columns (and those `carried` along) as they are, and the six fields: all for DW codes, wafer fields for
    LO codes. Null contents count as empty; a message without a field gives null there."""
    text = F.coalesce(F.col("contents"), F.lit(""))
    family = code_family(F.col("code"))

    def only(rules, *families):
        return [F.when(family.isin(*families), c).alias(r.name) for r, c in zip(rules, extract(text, rules), strict=True)]

    return logs.select(
        *SOURCE_COLUMNS,
        *only(HANDLE_RULES, "DW"),
        *only(WAFER_RULES, "DW", "LO"),
        *only(ERROR_RULES, "DW"),
        *carried,
    )


def unfit_values(code: Column, contents: Column) -> Column:
    """How many numbers of a message do not fit their columns and so are null there."""
    family = code_family(code)

    def of(rules, *families):
        return [F.when(family.isin(*families) & r.unfit(contents), 1).otherwise(0) for r in rules]

    every = [*of(HANDLE_RULES, "DW"), *of(WAFER_RULES, "DW", "LO"), *of(ERROR_RULES, "DW")]
    # Shorter numbers fit every column.
    return F.when(contents.rlike(r"\d{6}"), sum(every, F.lit(0))).otherwise(0)
