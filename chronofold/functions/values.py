"""Tagged values: one JSON object with one of ten type tags, kept as its JSON text.

An item is a MAP<STRING, STRING>: attribute name -> tagged value, such as
{"N":"30"}. Names are map keys, so any character is allowed in them. Numbers
stay strings until a caller asks for a type.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The type tags.
TAGS = ("S", "N", "BOOL", "NULL", "B", "SS", "NS", "BS", "M", "L")
IMAGE = "map<string,string>"
#: from_json() options under which only strict JSON parses.
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false", "mode": "PERMISSIVE"}


def attribute(item: Column | str, name: str) -> Column:
    """An attribute's tagged value, or null. Any name is safe."""
    return F.try_element_at(F.col(item) if isinstance(item, str) else item, F.lit(name))


def tag(value: Column) -> Column:
    """The value's type tag, or null if it isn't one object with one known tag."""
    keys = F.json_object_keys(value)
    return F.when((F.size(keys) == 1) & keys[0].isin(*TAGS), keys[0])


def as_string(value: Column) -> Column:
    return F.get_json_object(value, "$.S")


def as_number_text(value: Column) -> Column:
    """A number's exact digits."""
    return F.get_json_object(value, "$.N")


def as_decimal(value: Column, scale: int = 9) -> Column:
    return as_number_text(value).try_cast(f"decimal(38,{scale})")


def as_double(value: Column) -> Column:
    return as_number_text(value).try_cast("double")


def as_boolean(value: Column) -> Column:
    return F.get_json_object(value, "$.BOOL").try_cast("boolean")


def is_null_value(value: Column) -> Column:
    """True for an explicit null, which is not the same as an absent attribute."""
    return F.coalesce(tag(value) == "NULL", F.lit(False))


def as_binary(value: Column) -> Column:
    return F.unbase64(F.get_json_object(value, "$.B"))


def as_string_set(value: Column) -> Column:
    return F.array_sort(F.from_json(value, "SS array<string>")["SS"])


def as_number_set(value: Column) -> Column:
    return F.array_sort(F.from_json(value, "NS array<string>")["NS"])


def as_binary_set(value: Column) -> Column:
    return F.transform(F.from_json(value, "BS array<string>")["BS"], F.unbase64)


def as_map(value: Column) -> Column:
    """Names -> tagged values of a nested map."""
    return F.from_json(value, f"M {IMAGE}")["M"]


def as_list(value: Column) -> Column:
    """Tagged values of a list, in order."""
    return F.from_json(value, "L array<string>")["L"]


def tagged(kind: str, value: Column) -> Column:
    """The tagged value of a scalar: S, N, B (binary), BOOL or NULL."""
    if kind == "NULL":
        return F.lit('{"NULL":true}')
    shown = F.base64(value) if kind == "B" else value if kind == "BOOL" else value.cast("string")
    return F.to_json(F.struct(shown.alias(kind)))


def canonical(value: Column, depth: int = 3) -> Column:
    """Equal text for equal values: sets sorted, maps by name, to `depth` levels of nesting; deeper ones as they are."""
    kind = tag(value)
    sets = F.when(kind == "SS", F.to_json(F.struct(as_string_set(value).alias("SS")))).when(kind == "NS", F.to_json(F.struct(as_number_set(value).alias("NS"))))
    sets = sets.when(kind == "BS", F.to_json(F.struct(F.array_sort(F.from_json(value, "BS array<string>")["BS"]).alias("BS"))))
    if depth > 0:
        entries = F.array_sort(F.transform(F.map_entries(as_map(value)), lambda e: F.struct(e["key"].alias("k"), canonical(e["value"], depth - 1).alias("v"))))
        sets = sets.when(kind == "M", F.concat(F.lit('{"M":'), F.to_json(entries), F.lit("}")))
        sets = sets.when(kind == "L", F.concat(F.lit('{"L":'), F.to_json(F.transform(as_list(value), lambda v: canonical(v, depth - 1))), F.lit("}")))
    return sets.otherwise(value)


def canonical_item(item: Column, depth: int = 1) -> Column:
    """An item as text that is equal for equal items; null for null."""
    return F.to_json(F.array_sort(F.transform(F.map_entries(item), lambda e: F.struct(e["key"].alias("k"), canonical(e["value"], depth).alias("v")))))
