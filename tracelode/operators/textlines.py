"""Lines of text files as typed records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracelode.functions.text import LINE_END, strip


def parse_lines(files: DataFrame) -> DataFrame:
    """(source_file, line_number, record_type, key, value, columns, text): one row for each line that is
    not blank, numbered with the blank ones. A line with ``=`` is key_value (cut once), else one with
    a comma csv_like (cut everywhere), else raw; all parts are stripped. Null text has no lines."""
    lines = files.select("source_file", F.posexplode(F.split("text", LINE_END, -1)).alias("at", "line")).select(
        "source_file", (F.col("at") + 1).alias("line_number"), strip(F.col("line")).alias("line")
    )
    line = F.col("line")
    kind = F.when(line.contains("="), "key_value").when(line.contains(","), "csv_like").otherwise("raw")
    pair = F.split(line, "=", 2)
    is_ = lambda k: F.col("record_type") == k
    return (
        lines.where(line != "")
        .withColumn("record_type", kind)
        .select(
            "source_file",
            "line_number",
            "record_type",
            F.when(is_("key_value"), strip(pair[0])).alias("key"),
            F.when(is_("key_value"), strip(pair[1])).alias("value"),
            F.when(is_("csv_like"), F.transform(F.split(line, ",", -1), strip)).alias("columns"),
            F.when(is_("raw"), line).alias("text"),
        )
    )


def with_payload(records: DataFrame) -> DataFrame:
    """(source_file, line_number, record_type, payload_json): the record as compact JSON, characters kept."""

    def payload(kind: str, *names: str):
        fields = [F.col("record_type").alias("type"), "line_number", *names]
        return F.when(F.col("record_type") == kind, F.to_json(F.struct(*fields)))

    made = F.coalesce(payload("key_value", "key", "value"), payload("csv_like", "columns"), payload("raw", "text"))
    return records.select("source_file", "line_number", "record_type", made.alias("payload_json"))


def preview(records: DataFrame, most: int = 3) -> DataFrame:
    """The first `most` records of each file."""
    nth = F.row_number().over(W.partitionBy("source_file").orderBy("line_number"))
    return records.withColumn("nth", nth).where(F.col("nth") <= most)


def file_stats(files: DataFrame, records: DataFrame) -> DataFrame:
    """(source_file, text_length, n_records) of every file."""
    n = records.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_records"))
    return (
        files.select("source_file", F.length("text").alias("text_length"))
        .join(n, "source_file", "left")
        .withColumn("n_records", F.coalesce("n_records", F.lit(0)))
    )
