"""Small scalar expressions shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a costly ``value`` that later filters can use without evaluating it again.

    The optimizer moves a filter below a projection by writing the expression out a
    second time; it does not move one below a generator. So a parse or a decode goes
    through a one-element ``explode``.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def feature_string(*parts: Column, null_text: str = "NULL") -> Column:
    """Parts joined by ``|``; a NULL part reads as ``null_text``."""
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit(null_text)) for p in parts])


def window_text(ts: Column) -> Column:
    """A timestamp as text with milliseconds, the form every sink carries."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS")


def dated(day: Column, clock: Column) -> Column:
    """``<day>T<clock>``, NULL unless both are set and non-empty."""
    return F.when((day != "") & (clock != ""), F.concat(day, F.lit("T"), clock))


def flag(text: Column, default: bool) -> Column:
    """XML boolean text as BOOLEAN; missing or unreadable text takes the default."""
    return F.coalesce(text.try_cast("boolean"), F.lit(default))


def estimated_jaccard(left: Column, right: Column) -> Column:
    """Share of equal positions of two signatures.

    0.0 when either is NULL or empty or the lengths differ; a NULL element never
    matches.
    """
    equal = F.filter(F.zip_with(left, right, lambda x, y: F.coalesce(x == y, F.lit(False))), lambda z: z)
    comparable = (F.size(left) > 0) & (F.size(left) == F.size(right))
    return F.when(comparable, F.size(equal) / F.size(left)).otherwise(F.lit(0.0))
