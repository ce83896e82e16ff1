"""Ordered state per equipment: counter jumps and values carried forward.

Two forms give the same rows. The plain one is a window per equipment; the jump rule and the
carry-forward then share one exchange and one sort. In the sliced one an equipment's rows are cut
into slices of time: a window runs inside each slice, and what a slice hands on to later ones is a
table with one row for each equipment and slice. So an equipment with very many rows is as many
tasks as it has slices. `busy()` tells which form a run needs. Rows without an equipment, which take
no part in any state, are spread by a hash in both.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracelode.sources.scratch import written

#: A rise of the exposure handle from which a row is a test shot.
JUMP = 1000
LOG_ORDER = ("code_occur_time", "er_date", "er_index", "er_line", "code", "contents")
SLICE, SPREAD = "_slice", "_spread"
#: Rows of one equipment that one task sorts at most; beyond it a run is sliced.
MOST_ROWS = 5_000_000


def _nulls_last(order: Sequence[str]) -> Column:
    return F.struct(*[x for c in order for x in (F.col(c).isNull(), F.col(c))])


def last_values(
    rows: DataFrame,
    keys: Sequence[str],
    slice_by: Column | None,
    order: Sequence[str],
    values: Mapping[str, Column],
    *,
    with_current: bool,
    keep: bool = False,
) -> DataFrame:
    """`rows` with, per entry of `values`, the latest non-null value at or before (`with_current`) or
    before each row of its keys. Rows with a null key look only at their own spread part; callers leave
    their values out. With `keep` the helper columns stay, and the next call with the same keys and
    order needs no exchange of its own."""
    if SPREAD not in rows.columns:
        spread = F.when(F.col(keys[0]).isNull(), F.pmod(F.xxhash64(*order), F.lit(64))).otherwise(F.lit(0))
        rows = rows.withColumn(SPREAD, spread)
        if slice_by is not None:
            rows = rows.withColumn(SLICE, slice_by)
    parts = [SLICE] if slice_by is not None else []
    held = rows.withColumns({f"_v_{n}": v for n, v in values.items()})
    if slice_by is not None:
        # Both the windows and the slices' ends read it.
        held = written(held)
    inside = W.partitionBy(*keys, *parts, SPREAD).orderBy(*[F.asc_nulls_last(c) for c in order])
    inside = inside.rowsBetween(W.unboundedPreceding, 0 if with_current else -1)
    within = held.withColumns({f"_w_{n}": F.last(f"_v_{n}", ignorenulls=True).over(inside) for n in values})
    kept = [c for c in rows.columns if keep or c not in (SLICE, SPREAD)]
    if slice_by is None:
        return within.select(*kept, *[F.col(f"_w_{n}").alias(n) for n in values])
    ends = (
        held.where(F.col(keys[0]).isNotNull())
        .groupBy(*keys, SLICE)
        .agg(*[F.max_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), _nulls_last(order))).alias(f"_e_{n}") for n in values])
    )
    across = W.partitionBy(*keys).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    before = ends.select(*keys, SLICE, *[F.last(f"_e_{n}", ignorenulls=True).over(across).alias(f"_b_{n}") for n in values])
    met = within.join(before, [*keys, SLICE], "left")
    return met.select(*kept, *[F.coalesce(f"_w_{n}", f"_b_{n}").alias(n) for n in values])


def hourly() -> Column:
    return F.date_trunc("hour", F.col("code_occur_time"))


def busy(rows: DataFrame, most: int = MOST_ROWS, key: str = "eq_name") -> bool:
    """Whether an equipment (or other key) has more rows than one task should sort: a count over the key alone. It runs
    at once, so it is asked of a scan, where it reads one column, and handed to all that follows as `sliced`."""
    return bool(rows.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") > most).take(1))


def is_counted(prefix: str = "DW-") -> Column:
    """Rows whose handle takes part in the jump rule."""
    return F.col("eq_name").isNotNull() & F.upper("code").startswith(prefix) & F.col("exposure_handle").isNotNull()


def with_previous_handle(parsed: DataFrame, *, sliced: bool | None = None, keep: bool = False) -> DataFrame:
    """`parsed` with previous_handle: that of the equipment's last counted row before, dropped or not. Rows are
    sliced if an equipment is busy(), or as `sliced` says; the result is the same."""
    sliced = busy(parsed) if sliced is None else sliced
    value = {"previous_handle": F.when(is_counted(), F.col("exposure_handle"))}
    met = last_values(parsed, ["eq_name"], hourly() if sliced else None, LOG_ORDER, value, with_current=False, keep=keep)
    return met.withColumn("previous_handle", F.when(is_counted(), F.col("previous_handle")))


def is_test_shot(threshold: int = JUMP) -> Column:
    return F.coalesce(F.col("exposure_handle") - F.col("previous_handle") >= threshold, F.lit(False))


def drop_test_shots(parsed: DataFrame, threshold: int = JUMP, **form) -> DataFrame:
    """Rows but those whose handle rose by `threshold` or more; a dropped row's handle is still the
    previous one of the next. The first row of a run and rows without equipment always stay."""
    return with_previous_handle(parsed, **form).where(~is_test_shot(threshold)).drop("previous_handle")


def test_shots(parsed: DataFrame, threshold: int = JUMP, **form) -> DataFrame:
    """The rows that drop_test_shots() leaves out, with previous handle and difference."""
    return (
        with_previous_handle(parsed, **form)
        .where(is_test_shot(threshold))
        .withColumn("handle_diff", F.col("exposure_handle") - F.col("previous_handle"))
    )


def latest_wafer_state(parsed: DataFrame) -> DataFrame:
    """(eq_name, wafer_id, wafer_seq): per equipment both values of the newest row that has either."""
    newest = F.max_by(F.struct("wafer_id", "wafer_seq"), F.struct("code_occur_time", "er_date", "er_index"))
    return (
        parsed.where("eq_name is not null and (wafer_id is not null or wafer_seq is not null)")
        .groupBy("eq_name")
        .agg(newest.alias("s"))
        .select("eq_name", "s.wafer_id", "s.wafer_seq")
    )


def carry_forward(parsed: DataFrame, seed: DataFrame | None = None, *, sliced: bool | None = None) -> DataFrame:
    """wafer_id and wafer_seq filled, each by itself, from the equipment's last row that had it, else from
    `seed` (eq_name, wafer_id, wafer_seq). Rows without equipment stay as they are."""
    sliced = busy(parsed) if sliced is None else sliced
    known = F.col("eq_name").isNotNull()
    values = {f"_{c}": F.when(known, F.col(c)) for c in ("wafer_id", "wafer_seq")}
    met = last_values(parsed, ["eq_name"], hourly() if sliced else None, LOG_ORDER, values, with_current=True)
    if seed is not None:
        start = seed.select("eq_name", F.col("wafer_id").alias("_seed_id"), F.col("wafer_seq").alias("_seed_seq"))
        # One row for each equipment; the planner broadcasts it while it is small.
        met = met.join(start, "eq_name", "left")
    else:
        met = met.withColumns({"_seed_id": F.lit(None).cast("int"), "_seed_seq": F.lit(None).cast("int")})
    filled = {
        "wafer_id": F.coalesce("wafer_id", F.when(known, F.coalesce("_wafer_id", "_seed_id"))).cast("int"),
        "wafer_seq": F.coalesce("wafer_seq", F.when(known, F.coalesce("_wafer_seq", "_seed_seq"))).cast("int"),
    }
    return met.select(*[filled.get(c, F.col(c)).alias(c) for c in parsed.columns if c not in (SLICE, SPREAD)])


def handle_jump_audit(parsed: DataFrame, threshold: int = JUMP, *, sliced: bool | None = None) -> DataFrame:
    """Rises of more than `threshold` between an equipment's consecutive DW rows with a handle; rows
    without equipment are one group of their own."""
    rows = parsed.where(F.col("code").like("DW-%") & F.col("exposure_handle").isNotNull()).withColumn(
        "_eq", F.coalesce(F.col("eq_name"), F.lit(""))
    )
    order = ("code_occur_time", "er_date", "er_index")
    sliced = busy(rows, key="_eq") if sliced is None else sliced
    slices = hourly() if sliced else None
    met = last_values(rows, ["_eq"], slices, order, {"prev_exposure_handle": F.col("exposure_handle")}, with_current=False)
    return (
        met.withColumn("exposure_handle_diff", F.col("exposure_handle") - F.col("prev_exposure_handle"))
        .where(F.col("exposure_handle_diff") > threshold)
        .select(
            "eq_name", "code", "code_occur_time", "er_date", "er_index",
            "prev_exposure_handle", "exposure_handle", "exposure_handle_diff",
        )
        .orderBy("eq_name", "code_occur_time", "er_date", "er_index")
    )
