"""Field rules on single messages."""

from __future__ import annotations

import random
import re
from datetime import datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tracelode.functions import dose, root_cause
from tracelode.functions.text import extract, normalize_contents, snake_code, strip, strip_trailing_period

SAMPLE = (
    "scan 17 of field 4: dose outside its band\nde_err=0.1250000 [%]\nfurther lines follow\n"
    "n_slit=12\naction_handle=880\nexposure_handle:9041\n"
)


def logs(spark, *rows):
    made = [(20260501, i, "L1", "EQ1", code, datetime(2026, 5, 1, 10, 0, i), "SCANNER", "ER", "t", text) for i, (code, text) in enumerate(rows)]
    return spark.createDataFrame(
        made,
        "er_date int, er_index int, er_line string, eq_name string, code string, code_occur_time timestamp_ntz, "
        "belong string, type string, title string, contents string",
    )


@pytest.mark.parametrize(
    ("code", "text", "field", "value"),
    [
        ("DW-3411", SAMPLE, "exposure_handle", 9041),
        ("DW-3411", SAMPLE, "action_handle", 880),
        ("DW-3411", SAMPLE, "de_err", Decimal("0.1250000")),
        ("DW-3411", SAMPLE, "n_slit", 12),
        ("DW-3411", "nothing here", "exposure_handle", None),
        ("DW-3411", None, "de_err", None),
        ("DW-3411", "slot_seq=3", "wafer_seq", 3),
        ("DW-3411", "slot_seq=3", "wafer_id", None),
        ("DW-3411", "wafer_no=7", "wafer_id", None),
        ("LO-0061", "loading reticle for lot id 2111.", "wafer_id", 2111),
        ("LO-8166", "wafer(23) for lot(2111)", "wafer_seq", 23),
        ("LO-8166", "exposure_handle=5", "exposure_handle", None),
        ("DW-3411", "min_de_error=-1.38157", "de_err", Decimal("-1.3815700")),
        ("DW-3411", "lot(0) wafer_id=9", "wafer_id", 9),
        ("KE-9103", "lot(5)", "wafer_id", None),
        ("dw-3411", SAMPLE, "exposure_handle", None),
        ("DW-3411", "n_slit=99999999999", "n_slit", None),
        ("DW-3411", "de_err=123456.5", "de_err", None),
    ],
)
def test_dose_fields(spark, code, text, field, value):
    assert dose.parse_dose_warnings(logs(spark, (code, text))).first()[field] == value


REPORT = (
    "Dose error detected in file: lot17_B.tar.\\nRoot clause : Mirror drift (slow)\\nExposesue I D : 5120\\nTime : 2031-02-03T04:05:06.789+09:00"
    "\\nExposure length : 0.5 [s]\\nMin. dose error : -0.25 [perc]\\nMax. dose error : 0.2 [perc]"
    "\\nPulses_EUV<0.6DT_tot : 8.0\\nFED pulses : 1.5\\nOn drop MP dlgc=1: 77.5 [mJ]\\nSoftware version :9.1"
)


def causes(spark, *texts):
    return causes_frame(spark, *texts)


def causes_frame(spark, *texts, **options):
    rows = [("L1", "EQ1", "ER", "C", datetime(2026, 1, 1), "b", "t", str(i), x, "r", "k", None) for i, x in enumerate(texts)]
    kinds = ", ".join(f"{c} {'timestamp_ntz' if c == 'code_occur_time' else 'string'}" for c in root_cause.SOURCE_COLUMNS)
    return root_cause.parse_root_causes(spark.createDataFrame(rows, kinds), **options)


def test_root_cause_report(spark):
    (row,) = causes(spark, REPORT, "system info: normal message", None, "dose error detected in file: x\nroot cause :  \n").collect()
    assert row.source_file_name == "lot17_B.tar"
    assert (row.root_cause_message, row.root_cause_code) == ("Mirror drift (slow)", "mirror_drift_slow")
    assert row.source_exposure_id == 5120
    assert row.source_code_occur_time == datetime(2031, 2, 3, 4, 5, 6, 789000)
    assert row.dose_error == Decimal("-0.2500000")
    assert (row.pulses_euv_lt_0_6dt_tot, row.fed_pulses) == (8, None)
    assert row.on_drop_mp_dlgc1 == Decimal("77.5000000")
    assert row.software_version == "9.1"


def test_rules_agree_with_python_patterns(spark):
    rules = (*root_cause.IDENTITY_RULES, *root_cause.METRIC_RULES, *root_cause.INTEGRAL_RULES)
    text = REPORT.replace("\\n", "\n")
    got = spark.createDataFrame([(text,)], "t string").select(
        *[F.regexp_extract("t", "(?imd)" + r.patterns[0], 1).alias(r.name) for r in rules]
    ).first()
    for r in rules:
        found = re.search(r.patterns[0], text, re.IGNORECASE | re.MULTILINE)
        assert got[r.name] == (found[1] if found else ""), r.name


def test_one_pass_equals_each_rule_by_itself(spark):
    """Random reports: labels at the start of lines, inside them and next to each other, empty, repeated, with odd values."""
    draw = random.Random(5)
    labels = ["Dose error detected in file", "Root cause", "root  Clause", "Exposure ID", "Exposesue I D", "Time", "TIME", "Min. dose error", "Max.dose error",
              "Software version", *root_cause.METRICS, *root_cause.INTEGRAL_METRICS, "Sensitivity", "overtime"]
    values = ["5", "-0.25 [perc]", "+3.0", "1e-5", "n/a", "", "  ", ".", "x.tar.", "8.5.", "99999999999999999999", "2031-02-03t04:05:06z", "a: b", "Time: 7", "\r5"]
    texts = []
    for _ in range(600):
        parts = []
        for _ in range(draw.randrange(12)):
            parts.append(draw.choice([draw.choice(labels), draw.choice(labels).upper(), draw.choice(values)]))
            parts.append(draw.choice([":", " : ", ": ", "\t:\n", " "]))
            parts.append(draw.choice(values))
            parts.append(draw.choice(["\n", "\n", "\n", "\n ", "\r\n", " ", "\n\n", ""]))
        texts.append(("".join(parts),))
    rows = spark.createDataFrame([*texts, (None,), ("",)], "t string")
    # Python knows no year beyond 9999.
    shown = lambda df: df.withColumn("source_code_occur_time", F.col("source_code_occur_time").cast("string"))
    got = shown(root_cause.with_fields(rows, "t"))
    want = shown(rows.select("t", *extract(F.col("t"), root_cause.RULES)))
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert want.where("root_cause_message is not null").count() > 50 and want.where("fed_pulses is not null").count() > 5


def test_instants(spark):
    times = ["2031-02-03T04:05:06.5+09:00", "2031-02-03t04:05:06z", "2031-02-03T04:05:06", "2031-02-03", "soon", "2031-02-31T00:00:00Z"]
    texts = [f"dose error detected in file: x\nRoot cause: y\nTime: {t}" for t in times]
    got = {r.title: r for r in causes_frame(spark, *texts, instants=True).withColumn("us", F.unix_micros("source_code_occur_instant")).collect()}
    at = lambda *a: int(datetime(*a, tzinfo=timezone.utc).timestamp() * 1_000_000)
    assert [got[str(i)].us for i in range(6)] == [at(2031, 2, 2, 19, 5, 6) + 500_000, at(2031, 2, 3, 4, 5, 6), None, None, None, None]
    assert got["0"].source_code_occur_time == datetime(2031, 2, 3, 4, 5, 6, 500_000)


def test_dominant_value(spark):
    rows = [(Decimal("-2"), Decimal("1")), (Decimal("-1"), Decimal("1")), (Decimal("-1"), Decimal("3")), (None, Decimal("1")), (Decimal("1"), None), (None, None)]
    df = spark.createDataFrame(rows, "a decimal(12,7), b decimal(12,7)")
    got = [r[0] for r in df.select(root_cause.dominant_dose_error(F.col("a"), F.col("b"))).collect()]
    assert got == [-2, -1, 3, 1, 1, None]


def test_text_helpers(spark):
    rows = [("　 a.\x0b",), ("..",), ("",), (None,), ("A--b C!",)]
    df = spark.createDataFrame(rows, "t string")
    t = F.col("t")
    got = df.select(strip(t), strip_trailing_period(t), snake_code(t), normalize_contents(t)).collect()
    assert [tuple(r) for r in got] == [
        ("a.", "a", "a", "a."),
        ("..", ".", None, ".."),
        ("", None, None, ""),
        (None, None, None, None),
        ("A--b C!", "A--b C!", "a_b_c", "A--b C!"),
    ]


def test_root_cause_columns_are_the_tables():
    assert len(root_cause.PARSED_COLUMNS) == 52
    assert len(set(root_cause.PARSED_COLUMNS)) == 52
