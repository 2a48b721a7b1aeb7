"""Scalar column expressions: labels, flags, keys, days, measures."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

from tonetide.constants import DAY_FORMAT


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def binary_label(c: Column | str, value: int) -> Column:
    """1 where a textual label equals ``value``, else 0; null or malformed text gives 0.

    A number with decimals counts by its whole part, so ``"1.0"`` is 1.
    """
    return F.when(_column(c).try_cast("double").try_cast("int") == value, 1).otherwise(0)


def flag(probability: Column | str, threshold: float, float32: bool = False) -> Column:
    """1 where the probability is strictly above the threshold, else 0.

    ``float32=True`` rounds the probability to 32 bits first.
    """
    p = _column(probability)
    if float32:
        p = p.cast("float").cast("double")
    return F.when(p > F.lit(float(threshold)), 1).otherwise(0)


def class_probability(vector: Column | str, i: int = 1) -> Column:
    """Probability of class ``i`` from a model's probability vector, as double."""
    return vector_to_array(_column(vector))[i]


def ltrim_chars(c: Column | str, chars: str) -> Column:
    """Strip any leading run of the given *characters* (not the prefix)."""
    return F.ltrim(_column(c), F.lit(chars))


def strip_prefix(c: Column | str, prefix: str) -> Column:
    """Strip a prefix once."""
    c = _column(c)
    return F.when(
        c.startswith(prefix), c.substr(F.lit(len(prefix) + 1), F.length(c))
    ).otherwise(c)


def epoch_to_day(c: Column | str) -> Column:
    """Epoch seconds to a ``yyyy-MM-dd`` string in UTC, whatever the session's time zone."""
    days = F.floor(_column(c) / 86_400).cast("int")
    return F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), days), DAY_FORMAT)


def parse_day(c: Column | str) -> Column:
    """``yyyy-MM-dd`` string to date; malformed text gives null."""
    return F.try_to_date(_column(c), DAY_FORMAT)


def percent(c: Column | str) -> Column:
    """Mean of a 0/1 column, in percent (aggregate)."""
    return F.avg(_column(c)) * 100.0


def difference(a: Column | str, b: Column | str) -> Column:
    return _column(a) - _column(b)


def intensity(c: Column | str, vmin: float, vmax: float) -> Column:
    """Colour strength of a value: 1 at ``vmin`` falling to 0 at ``vmax``."""
    if not vmax > vmin:
        raise ValueError("vmax must be above vmin")
    return 1.0 - F.sqrt((_column(c) - vmin) / (vmax - vmin))
