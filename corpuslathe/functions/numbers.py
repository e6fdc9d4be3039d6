"""Numbers, bands and dates as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuslathe.functions.text import col


def decimal_comma(c: Column | str) -> Column:
    """A number written with a point or a comma; null if it isn't one."""
    return F.replace(col(c), F.lit(","), F.lit(".")).try_cast("double")


def clamp(c: Column, low: int, high: int) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def count_true(*flags: Column) -> Column:
    return sum((F.coalesce(f, F.lit(False)).cast("int") for f in flags), F.lit(0))


def band(c: Column | str, limits: list[tuple[float, str]], beyond: str) -> Column:
    """Name of the first limit that the value doesn't exceed, `beyond` above all; null stays null."""
    v, out = col(c), None
    for limit, name in limits:
        out = F.when(v <= limit, F.lit(name)) if out is None else out.when(v <= limit, F.lit(name))
    return out.when(v.isNotNull(), F.lit(beyond))


def length_band(c: Column | str) -> Column:
    return band(c, [(1000, "short"), (6000, "standard"), (12000, "long")], "very_long")


def marker_band(c: Column | str) -> Column:
    return band(c, [(2, "low"), (8, "medium")], "high")


def reference_band(c: Column | str) -> Column:
    return band(c, [(0, "none"), (4, "light")], "dense")


def backoff(attempt: Column | str, base: float = 1.0, most: float = 8.0) -> Column:
    """Seconds to wait after the given attempt (from 1), doubling up to a bound."""
    return F.least(F.lit(most), F.lit(base) * F.pow(F.lit(2.0), col(attempt) - 1))


def month(epoch: Column | str) -> Column:
    """Month of epoch seconds in UTC, `<null>` without."""
    return F.coalesce(F.date_format(F.timestamp_seconds(col(epoch)), "yyyy-MM"), F.lit("<null>"))


def spread(array: Column | str, most: int) -> Column:
    """At most `most` elements, from the beginning to the end at even steps."""
    a = col(array)
    if most <= 0:
        return F.slice(a, F.lit(1), F.lit(0))
    if most == 1:
        return F.slice(a, F.lit(1), F.lit(1))
    at = F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: F.floor((i * (F.size(a) - 1) + F.lit((most - 1) // 2)) / F.lit(most - 1)).cast("int"))
    return F.when(F.size(a) <= most, a).otherwise(F.transform(at, lambda i: F.get(a, i)))


def duration_state(declared: Column | str, metadata: Column | str) -> Column:
    """How two lists of durations relate; nulls don't count, and lists compare as sorted distinct numbers."""
    clean = lambda c: F.array_sort(F.array_distinct(F.array_compact(col(c).cast("array<double>"))))
    d, m = F.coalesce(clean(declared), F.array().cast("array<double>")), F.coalesce(clean(metadata), F.array().cast("array<double>"))
    nd, nm = F.size(d), F.size(m)
    return (
        F.when((nd > 0) & (nm > 0) & (d != m), "conflict").when(nd > 1, "multiple_declared").when(nm > 1, "multiple_metadata")
        .when((nd > 0) & (nm > 0), "consistent").when(nd > 0, "prompt_only").when(nm > 0, "asset_metadata_only").otherwise("missing")
    )


def durations_disjoint(declared: Column | str, metadata: Column | str) -> Column:
    """Both lists have numbers and share none: weaker than the state `conflict`."""
    d, m = F.array_compact(col(declared).cast("array<double>")), F.array_compact(col(metadata).cast("array<double>"))
    return F.coalesce((F.size(d) > 0) & (F.size(m) > 0) & ~F.arrays_overlap(d, m), F.lit(False))


def duration_observation(declared: Column | str, metadata: Column | str) -> Column:
    """(value, provenance): the one duration, or none where the lists differ or hold several."""
    d, m = F.array_distinct(F.array_compact(col(declared).cast("array<double>"))), F.array_distinct(F.array_compact(col(metadata).cast("array<double>")))
    nd, nm = F.size(d), F.size(m)
    differ = (nd > 0) & (nm > 0) & ((F.size(F.array_except(d, m)) > 0) | (F.size(F.array_except(m, d)) > 0))
    bad = differ | (nd > 1) | (nm > 1)
    value = F.when(~bad, F.coalesce(F.get(d, F.lit(0)), F.get(m, F.lit(0))))
    how = F.when(bad, "unresolved_conflict").when((nd > 0) & (nm > 0), "prompt_and_asset_agree").when(nd > 0, "prompt_only").when(nm > 0, "asset_metadata_only").otherwise("missing")
    return F.struct(value.alias("value"), how.alias("provenance"))
