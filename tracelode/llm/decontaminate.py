"""Benchmark decontamination with a broadcast set of normalised test n-grams.

Every benchmark item gives its windows of consecutive words. A window goes to the executors as its
hash, its words and its number. Training texts are scanned by token window: the window's
hash is looked up, and only where it is found the words themselves are compared. No Python runs;
a text is split once, and nothing but hits and one row for each document is shuffled. The items
of a window, however many they are, meet a document once its windows are known.

A benchmark whose windows are more bytes than may be broadcast is looked up in two steps: a bit table of
bounded size, made of the windows' hashes, is broadcast and drops nearly all windows of the texts;
those that it lets through meet the benchmark's in an exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelode.llm.common import ascii_lower, cut, wrapped

#: What stands between words once A-Z are lower case.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of windows that are broadcast at most.
MAX_BROADCAST = 256_000_000
#: Bytes that a broadcast row takes beside its words.
ROW_BYTES = 64
#: Words of 64 bits in the bit table, at most and at least: a table is twice the windows' number in words.
MOST_BITS, LEAST_BITS = 2**20, 2**10


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BREAK, -1), "")


def _window_hash(of: Column, start: Column, width: int) -> Column:
    """Hash of the `width` words from `start` (from 0); it equals that of their array."""
    return F.xxhash64(*[of[start + j] for j in range(width)])


def benchmark_windows(
    bench: DataFrame, width: int = 13, *, id_col: str = "item_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(b_len, b_text, b_h, b_nth), one numbered row for each distinct window, and (nth, item), a row for each
    window of an item; items as strings."""
    listed = bench.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w"))
    sized = listed.withColumn("n", F.size("w")).where("n > 0").withColumn("len", F.least("n", F.lit(width)))
    each = sized.select(
        "item",
        "len",
        F.explode(
            F.transform(F.sequence(F.lit(1), F.col("n") - F.col("len") + 1), lambda i: F.slice("w", i, F.col("len")))
        ).alias("window"),
    )
    each = cut(each.select("item", "len", F.array_join("window", " ").alias("text"), F.xxhash64("window").alias("h")).distinct())
    windows = cut(
        each.select(F.col("len").alias("b_len"), F.col("text").alias("b_text"), F.col("h").alias("b_h"))
        .distinct()
        .withColumn("b_nth", F.monotonically_increasing_id())
    )
    same = (F.col("h") == F.col("b_h")) & (F.col("len") == F.col("b_len")) & (F.col("text") == F.col("b_text"))
    return windows, each.join(windows.hint("merge"), same).select(F.col("b_nth").alias("nth"), "item")


def bit_table(hashes: DataFrame, n: int) -> tuple[DataFrame, int]:
    """(at, bits): the set bits of the hashes `h`, 64 to a row, and the number of rows that a full table has.
    It is twice `n` rows within bounds, so that few windows pass by chance while `n` is bounded."""
    size = min(MOST_BITS, max(LEAST_BITS, 2 * n))
    at = F.pmod("h", F.lit(size).cast("long"))
    return hashes.groupBy(at.alias("at")).agg(F.bit_or(_bit(F.col("h"))).alias("bits")), size


def _bit(h: Column) -> Column:
    """One of 64 bits, told by the upper bits of a hash."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 58).cast("int"))


def contamination(
    docs: DataFrame,
    bench: DataFrame,
    *,
    width: int = 13,
    share: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_broadcast: int = MAX_BROADCAST,
) -> DataFrame:
    """One row per row of `docs`: doc_id, text_key (MD5 of the text), n_words, n_hit, n_items, items (ids,
    as strings in order), spans (structs start, stop: the words hit, from 0), contaminated
    (n_hit > 0 and share * n_hit >= n_words).

    Items shorter than `width` words are one window of what they have; items without words or id take
    no part. Null text has no words; null ids stay; repeated rows each give a row; empty tables give
    an empty result (no documents) or no hits (no items).
    """
    windows, items = benchmark_windows(bench, width)
    size = F.octet_length("b_text") + ROW_BYTES
    sums = windows.groupBy("b_len").agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("bytes")).collect()
    counted, n_bytes = {r["b_len"]: r["n"] for r in sums}, sum(r["bytes"] for r in sums)
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"),
        words(F.col(text_col)).alias("w"),
    ).withColumn("n_words", F.size("w"))
    lengths = sorted(counted)
    many = len(lengths)
    # Place 0 stands for the document itself; the others for each start and window length in turn.
    # Outer, though never empty: the plain form adds a filter that splits the text once more.
    each = base.select(
        "doc_id", "text_key", "w", "n_words", F.explode_outer(F.sequence(F.lit(0), F.col("n_words") * many)).alias("place")
    )
    start = F.expr(f"(place - 1) div {max(many, 1)}").cast("int")
    which = F.expr(f"(place - 1) % {max(many, 1)}")
    length, h = F.lit(0), F.lit(None).cast("long")
    for i, n in enumerate(lengths):
        here = (which == i) if many > 1 else F.lit(True)
        length = F.when(here, n).otherwise(length)
        fits = (F.col("place") > 0) & here & (F.col("start") + n <= F.col("n_words"))
        h = F.when(fits, _window_hash(F.col("w"), F.col("start"), n)).otherwise(h)
    each = each.withColumn("start", start).withColumn("len", length)
    each = each.withColumn("h", h)
    at, upto = F.col("start"), F.col("start") + F.col("len")
    same_words = F.array_join(F.slice("w", F.greatest(at, F.lit(0)) + 1, F.col("len")), " ")
    own = F.col("place") == 0
    if n_bytes <= max_broadcast:
        found = each.join(F.broadcast(windows), F.col("h") == F.col("b_h"), "left").where(
            own | (F.col("b_h").isNotNull() & (F.col("b_len") == F.col("len")) & (same_words == F.col("b_text")))
        )
    else:
        table, size = bit_table(windows.select(F.col("b_h").alias("h")), sum(counted.values()))
        slot = F.pmod("h", F.lit(size).cast("long")) == F.col("at")
        kept = each.join(F.broadcast(cut(table)), slot, "left").where(own | (F.col("bits").bitwiseAND(_bit(F.col("h"))) != 0))
        # What is left carries its words, which tell for sure; a text's own row has none.
        narrow = kept.select("doc_id", "text_key", "n_words", "place", "start", "len", "h", F.when(~own, same_words).alias("words"))
        narrow = cut(narrow)
        here = (F.col("h") == F.col("b_h")) & (F.col("len") == F.col("b_len")) & (F.col("words") == F.col("b_text"))
        hits = narrow.where(~own).distinct().join(windows.hint("merge"), here)
        wanted = ["doc_id", "text_key", "n_words", "place", "start", "len", "b_nth"]
        found = hits.select(*wanted).union(narrow.where(own).withColumn("b_nth", F.lit(None).cast("long")).select(*wanted))
    grouped = found.groupBy("doc_id", "text_key").agg(
        F.max("n_words").alias("n_words"),
        F.count(F.when(own, 1)).alias("copies"),
        F.collect_set(F.when(~own, F.struct("start", upto.alias("stop")))).alias("hits"),
        F.collect_set(F.when(~own, F.col("b_nth"))).alias("nths"),
    )
    grouped = cut(grouped)
    hit, none = grouped.where(F.size("nths") > 0), grouped.where(F.size("nths") == 0)
    found_items = (
        hit.select(F.col("doc_id").alias("i_id"), F.col("text_key").alias("i_key"), F.explode("nths").alias("nth"))
        .join(items, "nth")
        .groupBy("i_id", "i_key")
        .agg(F.collect_set("item").alias("items"))
    )
    met = hit.join(found_items, F.col("doc_id").eqNullSafe(F.col("i_id")) & (F.col("text_key") == F.col("i_key")))
    columns = ["doc_id", "text_key", "n_words", "copies", "hits", "items"]
    grouped = met.select(*columns).union(none.withColumn("items", F.array().cast("array<string>")).select(*columns))
    # Sorted windows joined into spans: (all before, start and stop of the last).
    spans = F.aggregate(
        F.array_sort("hits"),
        F.expr("named_struct('done', cast(array() as array<struct<start:int,stop:int>>), 'start', 0, 'stop', 0)"),
        lambda a, x: F.when(
            x["start"] <= a["stop"],
            F.struct(a["done"].alias("done"), a["start"].alias("start"), F.greatest(a["stop"], x["stop"]).alias("stop")),
        ).otherwise(
            F.struct(
                F.concat(a["done"], F.array(F.struct(a["start"].alias("start"), a["stop"].alias("stop")))).alias("done"),
                x["start"].alias("start"),
                x["stop"].alias("stop"),
            )
        ),
        lambda a: F.filter(
            F.concat(a["done"], F.array(F.struct(a["start"].alias("start"), a["stop"].alias("stop")))),
            lambda s: s["stop"] > s["start"],
        ),
    )
    out = grouped.select(
        "doc_id",
        "text_key",
        "n_words",
        "copies",
        spans.alias("spans"),
        F.array_sort("items").alias("items"),
    ).select(
        "doc_id",
        "text_key",
        F.col("n_words").cast("long").alias("n_words"),
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"]).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        "items",
        "spans",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
    )
    return out.withColumn("contaminated", F.expr(f"n_hit > 0 and {share} * n_hit >= n_words")).drop("copy")


def decontaminated(docs: DataFrame, bench: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """`docs` without its contaminated rows; all columns, whatever they are called, and all other rows are
    kept. Null text is never contaminated; repeated rows go or stay together; without items all stay."""
    bad = contamination(docs, bench, id_col=id_col, text_col=text_col, **options).where("contaminated")
    bad = bad.select(F.col("doc_id").alias("bad_id"), F.col("text_key").alias("bad_key")).distinct()
    same = F.col("id").eqNullSafe(F.col("bad_id")) & (F.col("key") == F.col("bad_key"))
    return wrapped(docs, id_col, text_col).join(bad, same, "left_anti").select("row.*")
