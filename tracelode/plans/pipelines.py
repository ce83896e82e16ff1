"""Pipelines: the operators put together, source to result."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tracelode.functions import dose, root_cause
from tracelode.operators import ledger as books
from tracelode.operators.audit import run_summary
from tracelode.operators.carried import FREE, match_run, nothing_free
from tracelode.operators.filenames import accepted, publish_plan, rejected
from tracelode.operators.ledger_table import LedgerTable
from tracelode.operators.matching import match_exclusive, match_image_to_text
from tracelode.operators.state import busy, carry_forward, drop_test_shots, is_test_shot, latest_wafer_state, with_previous_handle
from tracelode.operators.textlines import parse_lines, with_payload
from tracelode.sources.files import decode_bodies, in_two_days
from tracelode.sources.logs import scan_dose_logs, scan_root_cause_logs
from tracelode.sources.scratch import is_written
from tracelode.sources.sinks import append_by_day, distinct_rows, projected


def dose_table(
    logs: DataFrame, start: datetime, end: datetime, seed: DataFrame | None = None, *, sliced: bool | None = None
) -> DataFrame:
    """Dose warnings of the window as result rows: parsed, test shots dropped, wafers carried forward
    from `seed` on, exact repeats removed. Machines are cut into slices of time if one has very many
    rows (counted first), or as `sliced` says; the rows are the same."""
    scanned = scan_dose_logs(logs, start, end)
    sliced = busy(scanned) if sliced is None else sliced
    filled = carry_forward(drop_test_shots(dose.parse_dose_warnings(scanned), sliced=sliced, keep=True), seed, sliced=sliced)
    return projected(distinct_rows(filled), dose.PARSED_COLUMNS, dose.INTEGER_COLUMNS)


def dose_pipeline(
    logs: DataFrame, window: tuple[datetime, datetime], seed_window: tuple[datetime, datetime], *, sliced: bool | None = None
) -> DataFrame:
    """dose_table() of `window`, seeded by the latest state of `seed_window`; both are counted as one."""
    if sliced is None:
        sliced = busy(scan_dose_logs(logs, min(window[0], seed_window[0]), max(window[1], seed_window[1])))
    return dose_table(logs, *window, seed=latest_wafer_state(dose_table(logs, *seed_window, sliced=sliced)), sliced=sliced)


def dose_run_summary(
    logs: DataFrame, start: datetime, end: datetime, seed: DataFrame | None = None, *, sliced: bool | None = None
) -> DataFrame:
    """(fetched, parsed, inserted) of a dose_table() run: rows scanned, rows but test shots, rows of the result.
    Test shots are marked instead of dropped, with no wafer to hand on, so that all three come from one run."""
    scanned = scan_dose_logs(logs, start, end)
    sliced = busy(scanned) if sliced is None else sliced
    marked = with_previous_handle(dose.parse_dose_warnings(scanned), sliced=sliced, keep=True)
    marked = marked.withColumn("_kept", ~is_test_shot()).drop("previous_handle")
    marked = marked.withColumns({c: F.when(F.col("_kept"), F.col(c)) for c in ("wafer_id", "wafer_seq")})
    filled = carry_forward(marked, seed, sliced=sliced)
    return run_summary(filled, "_kept", [c for c in filled.columns if c not in ("_kept", "created_at")])


def dose_load(
    logs: DataFrame, path: str, start: datetime, end: datetime, seed: DataFrame | None = None, *, sliced: bool | None = None
) -> dict[str, int]:
    """Appends dose_table() to the table at `path` and tells what the writing pass itself saw: rows `fetched`, rows `parsed`
    (all but test shots), rows `inserted`, and `nulled`, the numbers of fetched messages that no column holds. Nothing is read
    or counted a second time. Tasks that are run again after a lost executor can be seen twice; the table is right then too."""
    seen, kept, done = Observation(), Observation(), Observation()
    scanned = scan_dose_logs(logs, start, end)
    sliced = busy(scanned) if sliced is None else sliced
    one = F.count(F.lit(1))
    unfit = F.coalesce(F.sum(dose.unfit_values(F.col("code"), F.col("contents"))), F.lit(0)).cast("long")
    parsed = dose.parse_dose_warnings(scanned.observe(seen, one.alias("fetched"), unfit.alias("nulled")))
    left = drop_test_shots(parsed, sliced=sliced, keep=True).observe(kept, one.alias("parsed"))
    rows = projected(distinct_rows(carry_forward(left, seed, sliced=sliced)), dose.PARSED_COLUMNS, dose.INTEGER_COLUMNS)
    append_by_day(rows.observe(done, one.alias("inserted")), path)
    counts = {"fetched": 0, "nulled": 0, "parsed": 0, "inserted": 0}
    for each in (seen, kept, done):
        # The planner takes steps out once it finds their input empty; they saw nothing, and have no row to tell it.
        counts |= each.get if each._jo.getRow().length() else {}
    return counts


def root_cause_pipeline(logs: DataFrame, window: tuple[datetime, datetime]) -> DataFrame:
    """Root causes of the window as result rows, exact repeats removed."""
    parsed = root_cause.parse_root_causes(scan_root_cause_logs(logs, *window))
    return projected(distinct_rows(parsed), root_cause.PARSED_COLUMNS, root_cause.INTEGER_COLUMNS)


def text_pipeline(bodies: DataFrame) -> DataFrame:
    """Ledger rows of text files given as (source_file, content): decoded, cut in records, as JSON."""
    return with_payload(parse_lines(decode_bodies(bodies).select("source_file", "text")))


def image_run(inventory: DataFrame, published: DataFrame, prepared: DataFrame) -> DataFrame:
    """What an image-driven run brings to the ledger, for apply_run(): each image with the text of its folder that it
    is matched with, if any, and its output where that is there already."""
    named = accepted(inventory)
    images, texts = named.where("kind = 'image'"), named.where("kind = 'text'")
    # Paths that several files share are one ledger key; the lowest file stands for it.
    first = F.min_by(F.struct("file_id", "prefix", "file_ts", "folder_date", "kind"), "file_id")
    images = images.groupBy("path").agg(first.alias("f")).select("path", "f.*")
    plan = publish_plan(match_image_to_text(images, texts, every=True), published, prepared)
    return plan.select(
        F.col("image_path").alias("source_file"),
        "prefix",
        "image_ts",
        F.col("text_path").alias("matched_text_file"),
        F.col("text_ts").alias("matched_text_ts"),
        F.when(F.col("text_id").isNotNull(), F.col("diff_seconds")).alias("matched_diff_seconds"),
        F.when((F.col("action") == "record") & F.col("text_id").isNotNull(), F.col("output_path")).alias("output_remote_file"),
    )


def image_pipeline(inventory: DataFrame, ledger: DataFrame, published: DataFrame, prepared: DataFrame, now) -> DataFrame:
    """The ledger after an image-driven run: images entered, matched with a text of their folder or
    removed, and completed where their output is there already."""
    return books.apply_run(ledger, image_run(inventory, published, prepared), now)


def image_run_on_table(inventory: DataFrame, table: LedgerTable, published: DataFrame, prepared: DataFrame, now) -> list[int]:
    """image_pipeline() on a stored ledger: only the buckets of the run's images are read and written."""
    return table.apply(books.apply_run, image_run(inventory, published, prepared), now)


def matches_by_runs(files: DataFrame, cuts: list[datetime], folder: str) -> DataFrame:
    """The exclusive match of named files (accepted()), one run after another: a run for each two neighbours of `cuts`. Each
    reads the files of its own stretch and the images that the run before left free, and stores its pairs and what it
    leaves free below `folder`. A run that was stored is not done again."""
    spark = files.sparkSession
    texts, images = files.where("kind = 'text'"), files.where("kind = 'image'")
    free = nothing_free(spark)
    for since, until in zip(cuts, cuts[1:], strict=False):
        here = f"{folder}/until={until:%Y%m%dT%H%M%S}"
        if not is_written(spark, f"{here}/free"):
            pairs, left = match_run(texts, images, free, since, until)
            pairs.write.mode("overwrite").parquet(f"{here}/pairs")
            left.write.mode("overwrite").parquet(f"{here}/free")
        free = spark.read.schema(FREE).parquet(f"{here}/free")
    return spark.read.parquet(*[f"{folder}/until={until:%Y%m%dT%H%M%S}/pairs" for until in cuts[1:]])


def combined_pipeline(inventory: DataFrame, anchor: str | date, published: DataFrame, prepared: DataFrame) -> DataFrame:
    """Per text of the two target days: the image it takes, the output and what is to be done (store: no
    image)."""
    named = accepted(in_two_days(inventory, anchor))
    pairs = match_exclusive(named.where("kind = 'text'"), named.where("kind = 'image'"))
    plan = publish_plan(pairs, published, prepared)
    return plan.withColumn("action", F.when(F.col("image_id").isNull(), "store").otherwise(F.col("action")))


def file_outcomes(inventory: DataFrame) -> DataFrame:
    """(file_id, outcome) of an image-driven run: processed, skipped (no text) or error (name)."""
    named = accepted(inventory)
    images, texts = named.where("kind = 'image'"), named.where("kind = 'text'")
    hit = match_image_to_text(images, texts).select(F.col("image_id").alias("file_id"))
    bad = rejected(inventory).where("kind = 'image'").select("file_id", F.lit("error").alias("outcome"))
    return (
        hit.select("file_id", F.lit("processed").alias("outcome"))
        .unionByName(images.join(hit, "file_id", "left_anti").select("file_id", F.lit("skipped").alias("outcome")))
        .unionByName(bad)
    )
