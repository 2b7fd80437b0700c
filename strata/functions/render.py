"""Entity → flat attribute strings (dates, lists, maps)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed zone of rendered timestamps (second precision, numeric zone).
ZONE_SUFFIX = "+0000"


def render_ts(c: Column | str) -> Column:
    """State timestamps are naive UTC: render them as ``2023-11-14T22:13:20+0000``.
    Null stays null (open pull requests have no closed date)."""
    c = F.col(c) if isinstance(c, str) else c
    # by fields, not date_format: that reads a naive time in the session zone and shifts it in a DST gap
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    text = F.concat(F.lpad(F.year(c).cast("string"), 4, "0"), F.lit("-"), two(F.month(c)), F.lit("-"), two(F.day(c)),
                    F.lit("T"), two(F.hour(c)), F.lit(":"), two(F.minute(c)), F.lit(":"), two(F.second(c)))
    return F.when(c.isNotNull(), F.concat(text, F.lit(ZONE_SUFFIX)))


def with_attributes(df: DataFrame, *names: str, prefix: str = "") -> DataFrame:
    """``df`` with the columns ``names`` written into its ``attributes`` map as
    text (later ones win; nulls are left out)."""
    new = F.map_filter(F.map_from_arrays(F.array(*[F.lit(prefix + n) for n in names]),
                                         F.array(*[F.col(n).cast("string") for n in names])),
                       lambda k, v: v.isNotNull())
    if "attributes" not in df.columns:
        return df.withColumn("attributes", new)
    old = F.map_filter(F.coalesce("attributes", F.create_map().cast("map<string,string>")), lambda k, v: ~F.map_contains_key(new, k))
    return df.withColumn("attributes", F.map_concat(old, new))


def kept_metadata(c: Column | str) -> Column:
    """A metadata map without empty and null values; null is the empty map."""
    c = F.col(c) if isinstance(c, str) else c
    return F.map_filter(F.coalesce(c, F.create_map().cast("map<string,string>")), lambda k, v: v.isNotNull() & (v != ""))


def render_list(c: Column | str) -> Column:
    """``[a, b]`` rendering of an array column."""
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.lit("["), F.array_join(c, ", "), F.lit("]"))


def render_map(c: Column | str) -> Column:
    """``{k1=v1, k2=v2}`` rendering, keys sorted so the text is stable."""
    c = F.col(c) if isinstance(c, str) else c
    entries = F.array_sort(F.map_entries(c))
    return F.concat(F.lit("{"),
                    F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ", "),
                    F.lit("}"))


def metadata_map(**props: Column) -> Column:
    """Dynamic properties → metadata map; null and empty values are dropped."""
    keys = sorted(props)
    m = F.map_from_arrays(F.array(*[F.lit(k) for k in keys]),
                          F.array(*[props[k].cast("string") for k in keys]))
    return F.map_filter(m, lambda k, v: v.isNotNull() & (v != ""))


def sorted_metadata_text(c: Column | str) -> Column:
    """``k=v`` pairs joined by ``,`` in key order (input of commit ids)."""
    c = F.col(c) if isinstance(c, str) else c
    entries = F.array_sort(F.map_entries(c))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
