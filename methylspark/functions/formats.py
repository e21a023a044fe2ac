"""How numbers are rounded and written."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(methylated: Column, unmethylated: Column) -> Column:
    """Methylated of all, in percent, two places, halves to even; 0 without depth."""
    depth = methylated + unmethylated
    return F.when(depth > 0, F.bround(methylated / F.nullif(depth, F.lit(0)) * 100, 2)).otherwise(0.0)


def fixed(value: Column, places: int) -> Column:
    """Text with so many places, NA for null and what is not finite."""
    finite = value.isNotNull() & ~F.isnan(value.cast("double")) & (F.abs(value) < F.lit(float("inf")))
    return F.when(finite, F.format_string(f"%.{places}f", F.bround(value.cast("double"), places))).otherwise("NA")


def rate_percent(part: Column, whole: Column) -> Column:
    """"12.34%", NA where the whole is missing or not positive."""
    return F.when(whole > 0, F.concat(fixed(part / whole * 100, 2), F.lit("%"))).otherwise("NA")


def lenient_int(value: Column) -> Column:
    """A whole number from text, fractions cut off; null for anything else."""
    return value.try_cast("double").try_cast("int")
