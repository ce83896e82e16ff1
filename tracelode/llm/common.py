"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelode.sources.scratch import shared_folder

#: Characters of text that one Python step works on at a time; one longer text is a step by itself.
STEP_CHARS = 1_000_000

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Puts this package's folder on the path of Python workers that are yet to start.

    It helps where workers run on this machine; on a cluster the package is installed or shipped
    with ``--py-files``, and the extra entry does no harm.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    held = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in held.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, held]))


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """df.mapInArrow(run, schema) with workers that find this package."""
    importable(df.sparkSession)
    return df.mapInArrow(run, schema)


def cut(df: DataFrame) -> DataFrame:
    """`df` written once to the cluster's shared checkpoint folder and read from there on."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def named(column: str) -> Column:
    """A column by its name, whatever the name holds."""
    return F.col("`" + column.replace("`", "``") + "`")


def wrapped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, id, key): each row of `docs` as one struct, with its id and its text's MD5 (null counts as
    empty text). Joins on these meet no column of `docs`, whatever its columns are called."""
    every = F.struct(*map(named, docs.columns))
    return docs.select(
        every.alias("row"), named(id_col).alias("id"), F.md5(F.coalesce(named(text_col), F.lit(""))).alias("key")
    )


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character untouched."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with `value` worked out once, also where `use` reads it inside a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def steps(texts: Iterable[str | None], most: int = STEP_CHARS) -> Iterator[list[str]]:
    """Consecutive texts in lists of about `most` characters; null counts as empty text."""
    held: list[str] = []
    size = 0
    for text in texts:
        text = text or ""
        if held and size + len(text) > most:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held
