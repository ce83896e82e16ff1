"""Result tables: projections, writers and what goes with them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def projected(rows: DataFrame, columns: Sequence[str], integers: Mapping[str, str]) -> DataFrame:
    """The table's columns in order (those that `rows` has), whole numbers coerced; what does not fit is null."""
    return rows.select(
        *[(F.col(c).try_cast(integers[c]) if c in integers else F.col(c)).alias(c) for c in columns if c in rows.columns]
    )


def distinct_rows(rows: DataFrame) -> DataFrame:
    """Rows without exact repeats, created_at left out of the comparison."""
    keys = [c for c in rows.columns if c != "created_at"]
    return rows.dropDuplicates(keys)


def with_day(rows: DataFrame, time: str = "code_occur_time") -> DataFrame:
    return rows.withColumn("event_date", F.to_date(time))


def append_by_day(rows: DataFrame, path: str) -> None:
    """Adds rows to a table partitioned by day; created_at is set where it is missing. Each day is as many
    files as its size asks for: small days are put together and large ones split by the planner."""
    if "created_at" not in rows.columns:
        rows = rows.withColumn("created_at", F.current_timestamp())
    with_day(rows).hint("rebalance", "event_date").write.mode("append").partitionBy("event_date").parquet(path)


def overwrite_days(rows: DataFrame, path: str) -> None:
    """Replaces the days that `rows` has, and no others."""
    with_day(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path)


def append_to_table(rows: DataFrame, table: str, *, analyze: bool = False) -> None:
    """Adds rows to a table that must exist, and refreshes its statistics if wanted."""
    spark = rows.sparkSession
    if not spark.catalog.tableExists(table):
        raise ValueError(f"no table {table}")
    rows.write.mode("append").insertInto(table)
    if analyze:
        spark.sql(f"analyze table {table} compute statistics")


def append_days_to_table(rows: DataFrame, table: str, *, day: str = "event_date", columns: Sequence[str] = ()) -> list:
    """Adds rows to a table that must exist and is partitioned by the date column `day`, and refreshes statistics of the
    days that the writing pass itself saw, in order returned; files of other days are not read. The planner's own
    estimates (``spark.sql.cbo.enabled``) rest on the number of rows and the spread of days in the whole table, which come
    from the files' footers alone; `columns` names further columns to gather, for which their data are read.

    Columns are taken by name. Rows of no day are added, but have no statistics of their own."""
    spark = rows.sparkSession
    if not spark.catalog.tableExists(table):
        raise ValueError(f"no table {table}")
    seen = Observation()
    listed = rows.select(*[f"`{c}`" for c in spark.table(table).columns])
    listed.observe(seen, F.array_sort(F.collect_set(day)).alias("days")).hint("rebalance", day).write.mode("append").insertInto(table)
    days = seen.get.get("days", []) if seen._jo.getRow().length() else []
    for one in days:
        spark.sql(f"analyze table {table} partition ({day} = date'{one}') compute statistics")
    spark.sql(f"analyze table {table} compute statistics for columns {', '.join(f'`{c}`' for c in dict.fromkeys([day, *columns]))}")
    return days


def rows_by_statistics(spark: SparkSession, table: str, day: str, days: Sequence) -> dict:
    """Rows of each of the days as the catalog's statistics tell, without those that it knows nothing of."""
    found = {}
    for one in days:
        told = spark.sql(f"describe extended {table} partition ({day} = date'{one}')").where("col_name = 'Partition Statistics'").collect()
        if told and "rows" in told[0]["data_type"]:
            found[one] = int(told[0]["data_type"].split(",")[-1].split(" rows")[0])
    return found


#: How CSV files spell null; empty text is an empty field in quotes.
NULL = "\\N"


def write_csv(rows: DataFrame, path: str) -> None:
    """CSV with quotes doubled, line feeds kept and nulls told from empty texts."""
    rows.write.mode("overwrite").option("header", True).option("escape", '"').option("nullValue", NULL).csv(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", True)
        .option("nullValue", NULL)
        .csv(path)
    )


def rows_per_day(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.to_date("code_occur_time").alias("event_date")).agg(F.count(F.lit(1)).alias("n_rows"))
