"""Linking texts with images by name prefix and time.

Both kinds of a prefix are put in one sequence and matched by windows, never by pairing them off.
As a match spans five minutes at most, nearest matches are found inside time slices: rows close to a
slice's edge are put in the next slice too, so a busy prefix becomes many tasks. The exclusive
match is a stack of images that texts pop; its depth comes from sums per slice, joined to the sums
of earlier slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracelode.operators.state import busy, last_values
from tracelode.sources.scratch import written

#: Seconds that a match may span, the bound included.
REACH = 300
#: Files of one prefix that one task sorts at most; beyond it the exclusive match is sliced.
MOST_FILES = 500_000
#: Seconds in a slice; any value from REACH on gives the same result.
SLICE_SECONDS = 3600


def _seconds(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def _side(files: DataFrame, kind: str, keys: list[str]) -> DataFrame:
    return files.select(
        *keys, F.lit(kind).alias("kind"), "file_id", "path", "file_ts", _seconds(F.col("file_ts")).alias("at")
    )


def _nearest(
    asking: DataFrame, offered: DataFrame, keys: list[str], forward: bool, reach: int, every: bool = False
) -> DataFrame:
    """Each asking file with the nearest offered one at or after (`forward`) or at or before it; with `every`
    also those that have none within reach, with a null offer `o`."""
    slice_of = (F.col("at") / SLICE_SECONDS).cast("long")
    sign = -1 if forward else 1
    near = F.array_distinct(F.array(slice_of, ((F.col("at") + sign * reach) / SLICE_SECONDS).cast("long")))
    both = (
        _side(offered, "offer", keys)
        .withColumn("slice", F.explode(near))
        .unionByName(_side(asking, "ask", keys).withColumn("slice", slice_of))
    )
    # Offers come before askers of the same second, the one with the lowest path and id last of all.
    time = F.desc("at") if forward else F.asc("at")
    order = [time, F.when(F.col("kind") == "offer", 0).otherwise(1), F.desc("path"), F.desc("file_id")]
    window = W.partitionBy(*keys, "slice").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    offer = F.when(F.col("kind") == "offer", F.struct("file_id", "path", "file_ts", "at"))
    met = both.withColumn("o", F.last(offer, ignorenulls=True).over(window)).where("kind = 'ask'")
    gap = F.col("o.at") - F.col("at") if forward else F.col("at") - F.col("o.at")
    met = met.withColumn("o", F.when(gap <= reach, F.col("o"))).withColumn("diff_seconds", gap)
    return met if every else met.where("o is not null")


def match_image_to_text(images: DataFrame, texts: DataFrame, reach: int = REACH, *, every: bool = False) -> DataFrame:
    """Per image the nearest text of its prefix and folder, 0 to `reach` seconds later; a text may serve
    several images, images without one are left out unless `every`. Ties go to the lowest path, then id."""
    met = _nearest(images, texts, ["prefix", "folder_date"], True, reach, every)
    return met.select(
        "prefix", "folder_date", F.col("file_id").alias("image_id"), F.col("path").alias("image_path"), F.col("file_ts").alias("image_ts"),
        F.col("o.file_id").alias("text_id"), F.col("o.path").alias("text_path"), F.col("o.file_ts").alias("text_ts"), "diff_seconds",
    )


def match_text_to_image(texts: DataFrame, images: DataFrame, reach: int = REACH) -> DataFrame:
    """Per text the nearest image of its prefix, 0 to `reach` seconds earlier; images may be reused."""
    met = _nearest(texts, images, ["prefix"], False, reach)
    return met.select(
        "prefix", F.col("file_id").alias("text_id"), F.col("path").alias("text_path"), F.col("file_ts").alias("text_ts"),
        F.col("o.file_id").alias("image_id"), F.col("o.path").alias("image_path"), F.col("o.file_ts").alias("image_ts"), "diff_seconds",
    )


def stacked(texts: DataFrame, images: DataFrame, *, sliced: bool | None = None) -> DataFrame:
    """Both kinds as one sequence for each prefix, images being put on a stack and texts taking from it: `_level` is null
    for a text that found it empty, `o` what stands before a row at its level (of a text with a level, what it took). A
    prefix with very many files is cut into slices of time (counted first), or as `sliced` says."""
    both = _side(images, "image", ["prefix"]).unionByName(_side(texts, "text", ["prefix"]))
    sliced = busy(both, MOST_FILES, "prefix") if sliced is None else sliced
    is_image = F.col("kind") == "image"
    # Images before texts of the same second, images falling and texts rising by path and id.
    both = both.withColumns(
        {
            "_step": F.when(is_image, 1).otherwise(-1),
            "_part": (F.col("at") / SLICE_SECONDS).cast("long"),
            "_ip": F.when(is_image, F.col("path")),
            "_ii": F.when(is_image, F.col("file_id")),
        }
    )
    order = [F.asc("at"), F.desc("_step"), F.desc("_ip"), F.desc("_ii"), F.asc("path"), F.asc("file_id")]
    parts = ["_part"] if sliced else []
    inside = W.partitionBy("prefix", *parts).orderBy(*order)
    upto, before = inside.rowsBetween(W.unboundedPreceding, 0), inside.rowsBetween(W.unboundedPreceding, -1)
    summed = (
        both.withColumn("_s", F.sum("_step").over(upto))
        .withColumn("_n", F.row_number().over(inside))
        .withColumn("_m", F.min("_s").over(upto))
        .withColumn("_m_before", F.min("_s").over(before))
    )
    if sliced:
        summed = written(summed)
        sums = summed.groupBy("prefix", "_part").agg(F.sum("_step").alias("_total"), F.min("_s").alias("_low"))
        earlier = W.partitionBy("prefix").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
        offsets = (
            sums.withColumn("_base", F.coalesce(F.sum("_total").over(earlier), F.lit(0)))
            .withColumn("_floor", F.coalesce(F.min(F.col("_base") + F.col("_low")).over(earlier), F.lit(0)))
            .select("prefix", "_part", "_base", "_floor")
        )
        summed = summed.join(offsets, ["prefix", "_part"])
    else:
        summed = summed.withColumns({"_base": F.lit(0), "_floor": F.lit(0)})
    depth = F.col("_base") + F.col("_s")
    ground = F.least(F.lit(0), F.col("_floor"), F.col("_base") + F.col("_m"))
    # A text that goes below all that was before found the stack empty; it has no level.
    was = F.least(F.lit(0), F.col("_floor"), F.coalesce(F.col("_base") + F.col("_m_before"), F.lit(0)))
    level = F.when(is_image, depth - ground).when(depth >= was, depth - ground + 1)
    pairing = summed.withColumn("_level", level)
    entry = F.struct("kind", "file_id", "path", "file_ts", "at")
    if sliced:
        # Rows without a level, whose partner is dropped below, have a null key; they are spread.
        partner = last_values(pairing, ["_level", "prefix"], F.col("_part"), ["_n", "at"], {"o": entry}, with_current=False)
    else:
        partner = pairing.withColumn("o", F.lag(entry).over(W.partitionBy("prefix", "_level").orderBy("_n")))
    return partner


def matched(pairs: DataFrame, reach: int = REACH) -> DataFrame:
    """Texts (prefix, file_id, path, file_ts, at, o) with the image `o` that they took where it is near enough."""
    gap = F.col("at") - F.col("o.at")
    near = F.coalesce(gap <= reach, F.lit(False))
    met = pairs.withColumn("o", F.when(near, F.col("o"))).withColumn("diff_seconds", F.when(near, gap))
    return met.select(
        "prefix", F.col("file_id").alias("text_id"), F.col("path").alias("text_path"), F.col("file_ts").alias("text_ts"),
        F.col("o.file_id").alias("image_id"), F.col("o.path").alias("image_path"), F.col("o.file_ts").alias("image_ts"), "diff_seconds",
    )


def match_exclusive(texts: DataFrame, images: DataFrame, reach: int = REACH, *, sliced: bool | None = None) -> DataFrame:
    """Texts in order of time each take the nearest image of their prefix that is still free, at most
    `reach` seconds earlier. Every text gives a row, with null image columns where it has none.

    Texts of one second go in order of path and id; of images of one second the lowest path is taken
    first. A prefix with very many files is cut into slices of time (counted first), or as `sliced` says.
    """
    taken = F.col("_level").isNotNull() & (F.col("o.kind") == "image")
    rows = stacked(texts, images, sliced=sliced).where("kind = 'text'")
    return matched(rows.withColumn("o", F.when(taken, F.col("o"))), reach)


def unmatched_images(images: DataFrame, matched: DataFrame) -> DataFrame:
    """Images that no text took."""
    taken = matched.where("image_id is not null").select(F.col("image_id").alias("file_id"), F.col("image_path").alias("path"))
    return images.join(taken, ["file_id", "path"], "left_anti")
