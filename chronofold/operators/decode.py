"""Lines of a change log -> typed operations, or corrupt lines with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.functions.values import IMAGE, STRICT

FIELDS = ("Item", "Keys", "NewImage", "OldImage", "Metadata")
LINE = f"Item {IMAGE}, Keys {IMAGE}, NewImage {IMAGE}, OldImage {IMAGE}, Metadata {IMAGE}"
NO_KEYS = "key attributes are missing"


def is_one_object(line: Column) -> Column:
    """Whether the line is one JSON object and nothing else."""
    alone = F.json_array_length(F.concat(F.lit("["), line, F.lit("]"))) == 1
    return F.coalesce(alone & F.regexp_like(line, F.lit(r"^\s*[{]")), F.lit(False))


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns behind a generator of one row, which the optimizer doesn't copy into the expressions that read them."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def decode_lines(lines: DataFrame, line_column: str = "line") -> DataFrame:
    """Adds op (PUT, UPDATE, DELETE or null), keys, new_image, old_image, write_micros, is_corrupt, reason.

    A line with an Item is a PUT of it, whatever else it holds. Otherwise both
    images make an UPDATE, the new one a PUT, the old one a DELETE. A field that
    is there must be an object with distinct names; anything else is corrupt.
    Each line is parsed once, whatever is made of the columns.
    """
    line = F.col(line_column)
    parsed = computed_once(lines, __whole=is_one_object(line), __names=F.json_object_keys(line), __line=F.from_json(line, LINE, STRICT))
    there = {f: F.coalesce(F.array_contains("__names", f), F.lit(False)) for f in FIELDS}
    image = {f: F.col(f"__line.{f}") for f in FIELDS}
    ok = {f: there[f] & image[f].isNotNull() & (F.size(F.array_distinct(F.map_keys(image[f]))) == F.size(image[f])) for f in FIELDS}
    bad = F.lit(False)
    for f in ("Keys", "NewImage", "OldImage"):
        bad = bad | (there[f] & ~ok[f])
    op = (
        F.when(~F.col("__whole"), None)
        .when(there["Item"], F.when(ok["Item"], "PUT"))
        .when(bad, None)
        .when(there["NewImage"] & there["OldImage"], "UPDATE")
        .when(there["NewImage"], "PUT")
        .when(there["OldImage"], "DELETE")
    )
    reason = F.when(~F.col("__whole"), "not one JSON object").when(there["Item"], "Item is not an object of distinct names").when(bad, "an image is not an object of distinct names").otherwise("no image")
    full = there["Item"] & ok["Item"]
    micros = F.get_json_object(F.try_element_at(image["Metadata"], F.lit("WriteTimestampMicros")), "$.N").try_cast("bigint")
    typed = computed_once(parsed, op=op, __full=full)
    return computed_once(
        typed,
        keys=F.when(F.col("op").isNotNull() & ~F.col("__full"), image["Keys"]),
        new_image=F.when(F.col("op").isin("PUT", "UPDATE"), F.when(F.col("__full"), image["Item"]).otherwise(image["NewImage"])),
        old_image=F.when(F.col("op").isin("UPDATE", "DELETE"), image["OldImage"]),
        write_micros=F.coalesce(micros, F.lit(0).cast("bigint")),
        is_corrupt=F.col("op").isNull(),
        reason=F.when(F.col("op").isNull(), reason),
    ).drop("__whole", "__names", "__line", "__full")


def with_keys(operations: DataFrame, key_columns: list[str]) -> DataFrame:
    """Fills `keys` from the images where a line brings none, as full exports do. An operation without all key attributes is corrupt: it can't be applied."""
    wanted = F.array(*[F.lit(k) for k in key_columns])
    source = F.coalesce("keys", F.when(F.col("op") == "DELETE", F.col("old_image")).otherwise(F.col("new_image")))
    picked = F.map_filter(source, lambda k, _: F.array_contains(wanted, k))
    whole = F.coalesce(F.size(picked) == len(key_columns), F.lit(False))
    keyless = F.col("op").isNotNull() & ~whole
    found = computed_once(operations.withColumnsRenamed({c: f"__{c}" for c in ("op", "keys", "is_corrupt", "reason")}).select("*", F.col("__op").alias("op"), F.col("__keys").alias("keys")), __picked=F.when(whole, picked), __keyless=keyless)
    columns = {
        "op": F.when(~F.col("__keyless"), F.col("__op")), "keys": F.col("__picked"), "is_corrupt": F.col("__is_corrupt") | F.col("__keyless"),
        "reason": F.when(F.col("__keyless"), NO_KEYS).otherwise(F.col("__reason")),
    }
    return found.select(*[columns[c].alias(c) if c in columns else F.col(f"`{c}`") for c in operations.columns])
