"""Text helpers and the extraction specification.

A field is described once (patterns, type, least value, trailing period) and compiled to a column
expression, so that rules are data and every rule stays inside Catalyst.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Case-insensitive, ^ and $ at line ends, only \n ends a line.
FLAGS = "(?imd)"
# Number captures that rules share.
INTEGER = r"([+-]?\d+)"
DECIMAL = r"([+-]?\d+(?:\.\d+)?)"

#: Characters that count as blank at either end of a text.
BLANKS = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
#: Line ends, beyond \n also \r, VT, FF, FS, GS, RS, NEL, LS and PS.
LINE_END = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]"


def strip(text: Column) -> Column:
    """`text` without blanks of any kind at both ends."""
    return F.trim(text, F.lit(BLANKS))


def strip_trailing_period(text: Column) -> Column:
    """Stripped text without one final period; empty gives null."""
    bare = strip(F.regexp_replace(strip(text), r"\.\z", ""))
    return F.nullif(bare, F.lit(""))


def normalize_contents(contents: Column) -> Column:
    """A literal backslash-n becomes a line feed; blanks at the ends go. Other escapes stay."""
    return strip(F.replace(contents, F.lit("\\n"), F.lit("\n")))


def first_group(text: Column, pattern: str) -> Column:
    """Group 1 of the first match, null where there is none."""
    return F.nullif(F.regexp_extract(text, FLAGS + pattern, 1), F.lit(""))


def snake_code(value: Column) -> Column:
    """Lower case, runs of other characters as one underscore, none at the ends; empty gives null."""
    runs = F.regexp_replace(F.lower(value), "[^a-z0-9]+", "_")
    return F.nullif(F.regexp_replace(runs, r"\A_+|_+\z", ""), F.lit(""))


@dataclass(frozen=True)
class FieldRule:
    """One field to extract: the first pattern with an acceptable value wins.

    kind: int, long, decimal, integral (a decimal kept only if whole), text or time. Values that do
    not fit their type are null; values below `minimum` fall through to the next pattern.
    """

    name: str
    patterns: tuple[str, ...]
    kind: str = "text"
    minimum: int | None = None
    trim_period: bool = False

    def column(self, text: Column) -> Column:
        # A number or time cast from the empty text is null, so only texts need first_group().
        got = first_group if self.kind == "text" else lambda t, p: F.regexp_extract(t, FLAGS + p, 1)
        found = [self.typed(got(text, p)) for p in self.patterns]
        if self.minimum is not None:
            found = [F.when(v >= self.minimum, v) for v in found]
        return F.coalesce(*found).alias(self.name)

    def unfit(self, text: Column) -> Column:
        """Whether a pattern finds a number that its type does not hold, so that it is null."""
        found = [F.regexp_extract(text, FLAGS + p, 1) for p in self.patterns]
        return any_of([(v != "") & self.typed(v).isNull() for v in found])

    def typed(self, value: Column) -> Column:
        if self.kind == "text":
            return strip_trailing_period(value) if self.trim_period else F.nullif(strip(value), F.lit(""))
        if self.kind == "time":
            return F.upper(value).try_cast("timestamp_ntz")
        if self.kind == "integral":
            exact = value.try_cast("decimal(38,18)")
            return F.when(exact == F.floor(exact), exact).try_cast("int")
        return value.try_cast("decimal(12,7)" if self.kind == "decimal" else self.kind)


def extract(text: Column, rules: tuple[FieldRule, ...]) -> list[Column]:
    return [rule.column(text) for rule in rules]


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
