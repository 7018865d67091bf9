"""Comparing two keyed tables, and counting what a restore should leave."""

from __future__ import annotations

import json
from decimal import Context, Decimal, InvalidOperation

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Numbers have 38 digits at most; none is rounded.
EXACT = Context(prec=400)


def canonical_value(value: object) -> object:
    """A tagged value, parsed, in a form that is equal for equal values at any depth: sets sorted, maps by name, numbers by value."""
    if not isinstance(value, dict) or len(value) != 1:
        return value
    [(tag, own)] = value.items()
    if tag == "N":
        return {tag: canonical_number(own)}
    if tag == "NS" and isinstance(own, list):
        return {tag: sorted(map(canonical_number, own))}
    if tag in ("SS", "BS") and isinstance(own, list):
        return {tag: sorted(own)}
    if tag == "M" and isinstance(own, dict):
        return {tag: {k: canonical_value(own[k]) for k in sorted(own)}}
    if tag == "L" and isinstance(own, list):
        return {tag: [canonical_value(x) for x in own]}
    return value


def canonical_number(digits: object) -> str:
    """The same text for 1, 1.0 and 1e0; what is no number stays."""
    try:
        number = Decimal(str(digits))
    except InvalidOperation:
        return str(digits)
    return str(EXACT.add(number, 0).normalize(EXACT)) if number.is_finite() else str(digits)


def whole_canonical(item: Column) -> Column:
    """An item as text that is equal for equal items, nested as deep as may be; null for null.

    JSON has no end of nesting that an expression could follow, so this is a
    Pandas function, used only here.
    """

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else json.dumps({k: canonical_value(_parsed(x)) for k, x in sorted(json.loads(t).items())}, sort_keys=True))

    return F.pandas_udf(run, "string")(F.to_json(item))


def _parsed(text: str | None) -> object:
    try:
        return json.loads(text, parse_float=str, parse_int=str) if text is not None else None
    except ValueError:
        return text


def compare_tables(source: DataFrame, target: DataFrame) -> DataFrame:
    """(key, status): missing (not in the target), extra (not in the source) or changed. Both: (key, item), unique by key.

    Items are compared by the hash of their canonical text, so only keys and
    hashes are shuffled.
    """
    side = lambda t, name: t.select("key", F.sha2(whole_canonical(F.col("item")), 256).alias(name))
    both = side(source, "a").join(side(target, "b"), "key", "full_outer")
    status = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").when(F.col("a") != F.col("b"), "changed")
    return both.select("key", status.alias("status")).where("status is not null")


def compare_counts(source: DataFrame, target: DataFrame, deletions: int = 0) -> DataFrame:
    """One row: expected (source less deletions), actual, equal."""
    n = source.agg((F.count(F.lit(1)) - deletions).alias("expected")).crossJoin(target.agg(F.count(F.lit(1)).alias("actual")))  # one row each
    return n.withColumn("equal", F.col("expected") == F.col("actual"))


def multiset_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one table that the other lacks, with the side they are on."""
    return a.exceptAll(b).withColumn("side", F.lit("source")).unionByName(b.exceptAll(a).withColumn("side", F.lit("target")))
