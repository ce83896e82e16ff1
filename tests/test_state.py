"""Jump rule and carry-forward against plain loops."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from tracelode.operators import state
from tracelode.operators.audit import missing_from_parsed, null_counts, repeated_keys
from tracelode.sources import logs as sources

KINDS = (
    "er_date int, er_index int, er_line string, eq_name string, code string, code_occur_time timestamp_ntz, belong string, "
    "type string, title string, contents string, exposure_handle long, action_handle long, wafer_id int, wafer_seq int, "
    "de_err decimal(12,7), n_slit int"
)


def parsed(spark, rows):
    made = [
        (20260501, i, "L1", eq, code, at, "b", "t", "x", "c", handle, None, wafer, seq, None, None)
        for i, (eq, code, at, handle, wafer, seq) in enumerate(rows)
    ]
    return spark.createDataFrame(made, KINDS)


def by_loop(rows, seed):
    handles, held, out = {}, {k: list(v) for k, v in seed.items()}, []
    for i, (eq, code, _, handle, wafer, seq) in sorted(enumerate(rows), key=lambda x: (x[1][2], x[0])):
        if eq is not None and code.startswith("DW-") and handle is not None:
            before = handles.get(eq)
            handles[eq] = handle
            if before is not None and handle - before >= state.JUMP:
                continue
        if eq is not None:
            mine = held.setdefault(eq, [None, None])
            mine[0] = wafer if wafer is not None else mine[0]
            mine[1] = seq if seq is not None else mine[1]
            wafer, seq = mine
        out.append((i, wafer, seq))
    return sorted(out, key=lambda x: x[0])


def random_rows(n, seed=3):
    rnd = random.Random(seed)
    start = datetime(2026, 5, 1)
    rows, handle = [], 0
    for _ in range(n):
        handle += rnd.choice([1, 5, 999, 1000, 1500])
        rows.append(
            (
                rnd.choice([None, "A", "B", "C"]),
                rnd.choice(["DW-3411", "LO-0061", "KE-9103"]),
                start + timedelta(minutes=rnd.randrange(600)),
                rnd.choice([None, handle]),
                rnd.choice([None, None, rnd.randrange(1, 9)]),
                rnd.choice([None, None, rnd.randrange(1, 9)]),
            )
        )
    return rows


@pytest.mark.parametrize("sliced", [True, False])
def test_both_forms_equal_a_row_loop(spark, sliced):
    rows = random_rows(1500)
    seed = {"A": (7, None), "Z": (1, 1)}
    table = spark.createDataFrame([(k, *v) for k, v in seed.items()], "eq_name string, wafer_id int, wafer_seq int")
    kept = state.drop_test_shots(parsed(spark, rows), sliced=sliced, keep=True)
    got = state.carry_forward(kept, table, sliced=sliced)
    assert got.columns == parsed(spark, rows[:1]).columns
    assert sorted((r.er_index, r.wafer_id, r.wafer_seq) for r in got.collect()) == by_loop(rows, seed)


def test_middle_of_a_jump_goes(spark):
    at = datetime(2026, 5, 1, 10)
    rows = [("E", "DW-3411", at + timedelta(hours=i), h, None, None) for i, h in enumerate([2631, 3631, 3632])]
    df = parsed(spark, rows)
    assert sorted(r.exposure_handle for r in state.drop_test_shots(df).collect()) == [2631, 3632]
    (shot,) = state.test_shots(df).collect()
    assert (shot.previous_handle, shot.handle_diff) == (2631, 1000)
    (jump,) = state.handle_jump_audit(state.drop_test_shots(df)).collect()
    assert (jump.prev_exposure_handle, jump.exposure_handle_diff) == (2631, 1001)


def test_latest_state_takes_both_values_from_one_row(spark):
    at = datetime(2026, 5, 1)
    df = parsed(spark, [("E", "LO-1", at, None, 5, 6), ("E", "LO-1", at + timedelta(1), None, 7, None), ("F", "LO-1", at, None, None, None)])
    assert [tuple(r) for r in state.latest_wafer_state(df).collect()] == [("E", 7, None)]


def test_empty_table(spark):
    df = parsed(spark, random_rows(3)).limit(0)
    assert state.carry_forward(state.drop_test_shots(df)).count() == 0
    assert state.latest_wafer_state(df).count() == 0


def test_audits(spark):
    at = datetime(2026, 5, 1)
    df = parsed(spark, [("E", "DW-3411", at, 1, None, None), (None, "DW-3411", at, 2, None, None), ("G", "DW-3411", at, 3, None, None)])
    start, end = sources.day_window(target=at.date())
    gone = missing_from_parsed(df, df.where("er_index < 2"), start, end)
    assert sorted(r.er_index for r in gone.collect()) == [1, 2]
    safe = missing_from_parsed(df, df.where("er_index < 2"), start, end, null_safe=True)
    assert [r.er_index for r in safe.collect()] == [2]
    assert repeated_keys(df, ["code_occur_time"]).first().n_rows == 3
    assert {r.column_name: r.n_nulls for r in null_counts(df, ["eq_name", "code"]).collect()} == {"eq_name": 1, "code": 0}


def test_windows():
    assert sources.day_window(target=datetime(2026, 5, 1).date()) == (datetime(2026, 5, 1), datetime(2026, 5, 2))
    for bad in ({}, {"start": datetime(2026, 5, 1)}, {"start": datetime(2026, 5, 1), "end": datetime(2026, 5, 1)}):
        with pytest.raises(ValueError, match="start"):
            sources.day_window(**bad)


def test_window_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "logs")
    parsed(spark, random_rows(50)).write.parquet(path)
    plan = sources.scan_dose_logs(spark.read.parquet(path), datetime(2026, 5, 1), datetime(2026, 5, 2))
    text = plan._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(code_occur_time" in text
    assert "exposure_handle" not in text.split("ReadSchema")[1]


def test_plain_form_has_one_exchange_and_one_sort(spark, tmp_path):
    path = str(tmp_path / "rows")
    parsed(spark, random_rows(50)).write.parquet(path)
    rows = spark.read.parquet(path)
    assert not state.busy(rows)
    assert state.busy(rows, most=3)
    plan = state.carry_forward(state.drop_test_shots(rows, sliced=False, keep=True), sliced=False)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Sort [") == 1
    assert text.count("Window [") == 2
