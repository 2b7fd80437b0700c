"""Parameter binding and validation for request DataFrames.

A request row carries typed parameter columns and, optionally, an
``attributes`` MAP<STRING,STRING> (the flow-record attributes).  A parameter
binds the first of: its column, the attribute of the same (or given) name,
a default.  Validation never fails the job: each rule yields an error code
and the first failing rule wins.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Param:
    name: str
    dtype: str = "string"          # Spark SQL type the value is cast to
    default: Any = None
    attribute: str | None = None   # attribute key (defaults to ``name``)


def _blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c.cast("string")) == "", F.lit(None)).otherwise(c)


def bind(requests: DataFrame, params: list[Param]) -> DataFrame:
    """Add/overwrite one typed column per parameter: column → attribute → default.

    A given value that does not parse as the parameter type is noted in
    ``_bad_type`` before any default applies, so ``validate`` reports it
    instead of silently defaulting.  All columns are added in two projections
    (one analysis each)."""
    cols = set(requests.columns)
    has_attrs = "attributes" in cols
    raws, typed, bad = {}, {}, F.lit(None).cast("string")
    for p in params:
        sources = []
        if p.name in cols:
            sources.append(_blank_to_null(F.col(p.name).cast("string")))
        if has_attrs:
            sources.append(_blank_to_null(F.element_at(F.col("attributes"), F.lit(p.attribute or p.name))))
        raws[f"_raw_{p.name}"] = F.coalesce(*sources) if sources else F.lit(None).cast("string")
        t = F.col(f"_raw_{p.name}")
        if p.dtype != "string":
            bad = F.coalesce(bad, F.when(t.isNotNull() & t.try_cast(p.dtype).isNull(), F.lit(f"bad_type:{p.name}")))
            t = t.try_cast(p.dtype)
        if p.default is not None:
            t = F.coalesce(t, F.lit(p.default).cast(p.dtype))
        typed[p.name] = t
    return requests.withColumns(raws).withColumns(typed | {"_bad_type": bad})


def rule_required(name: str) -> tuple[Column, str]:
    c = F.col(name)
    return (c.isNull() | (F.trim(c.cast("string")) == "")), f"empty:{name}"


def rule_positive(name: str) -> tuple[Column, str]:
    c = F.col(name)
    return (c.isNotNull() & (c <= 0)), f"not_positive:{name}"


def rule_allowed(name: str, values: list[str]) -> tuple[Column, str]:
    c = F.col(name)
    return (c.isNotNull() & ~c.isin(*values)), f"not_allowed:{name}"


def validate(df: DataFrame, rules: list[tuple[Column, str]], out: str = "error_code") -> DataFrame:
    """``error_code`` = code of a value that ``bind`` could not parse, else of
    the first failing rule (null when valid)."""
    expr = F.lit(None).cast("string")
    for cond, code in reversed(rules):
        expr = F.when(cond, F.lit(code)).otherwise(expr)
    if "_bad_type" in df.columns:
        expr = F.coalesce(F.col("_bad_type"), expr)
    res = df.withColumn(out, expr)
    return res.drop("_bad_type", *[c for c in res.columns if c.startswith("_raw_")])


def self_requests(spark: SparkSession, **values: Any) -> DataFrame:
    """Input mode "allowed": no incoming requests → one request of literals."""
    row = {"seq": 0, **values}
    return spark.createDataFrame([row])


def without_requests(operator):
    """Input mode "allowed": with ``requests=None`` an operator runs once, on one
    request (seq 0) made of ``values``; parameters without a value take their
    defaults as in any request.  Columns and types are those of the values."""
    @functools.wraps(operator)
    def run(requests: DataFrame | None, *state, values: dict[str, Any] | None = None, **given):
        if requests is None:
            requests = self_requests(state[0].sparkSession, **(values or {}))
        elif values is not None:
            raise ValueError("values: only without requests")
        return operator(requests, *state, **given)
    return run
