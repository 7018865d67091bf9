"""Applying operations to a keyed table: replace, patch and delete in a defined order.

PUT replaces the item. DELETE removes it; there need not be one. UPDATE sets
the new image's attributes that aren't keys, removes those of the old image
that the new one lacks, and leaves all others; it creates an item from the
keys where there is none, and does nothing at all when it neither sets nor
removes.

The default works attribute by attribute: each operation becomes rows
(key, attribute, order, what to do), and for each attribute only the last one
counts if it is not older than the key's last PUT or DELETE. That is one
aggregation with partial sums before its shuffle, so a hot key costs one row
an attribute and task, and one regrouping by key of what is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Names of rows that stand for the operation itself. No attribute has a null name.
LAST_WRITE, LAST_UPDATE = 0, 1


def key_text(keys: Column) -> Column:
    """A key map as text, names in order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(keys))))


def sets_of(keys: Column, new_image: Column) -> Column:
    """What an UPDATE sets."""
    return F.map_filter(new_image, lambda k, _: ~F.map_contains_key(keys, k))


def removes_of(keys: Column, new_image: Column, old_image: Column) -> Column:
    """The names that an UPDATE removes."""
    return F.filter(F.map_keys(old_image), lambda k: ~F.map_contains_key(keys, k) & ~F.map_contains_key(new_image, k))


def update_expression(sets: Column, removes: Column) -> Column:
    """The update in words: SET names REMOVE names, in order."""
    names = F.array_sort(F.map_keys(sets))
    return F.concat_ws(" ", F.when(F.size(sets) > 0, F.concat(F.lit("SET "), F.concat_ws(", ", names))), F.when(F.size(removes) > 0, F.concat(F.lit("REMOVE "), F.concat_ws(", ", F.array_sort(removes)))))


def attribute_rows(operations: DataFrame) -> DataFrame:
    """(key, keys, mark, attr, seq, value, is_set, op) of every effect; nothing for an UPDATE without effect."""
    empty = F.create_map().cast("map<string,string>")
    keys, new, old = (F.coalesce(c, empty) for c in ("keys", "new_image", "old_image"))
    sets, removes = sets_of(keys, new), removes_of(keys, new, old)

    def effect(attr: Column, value: Column, is_set: bool) -> Column:
        return F.struct(F.lit(None).cast("int").alias("mark"), attr.alias("attr"), value.alias("value"), F.lit(is_set).alias("is_set"))

    def marked(mark: int) -> Column:
        return F.array(F.struct(F.lit(mark).cast("int").alias("mark"), F.lit("").alias("attr"), F.lit(None).cast("string").alias("value"), F.lit(False).alias("is_set")))

    all_set = lambda image: F.transform(F.map_entries(image), lambda e: effect(e["key"], e["value"], True))
    patch = F.concat(marked(LAST_UPDATE), all_set(sets), F.transform(removes, lambda k: effect(k, F.lit(None).cast("string"), False)))
    effects = F.when(F.col("op") == "PUT", F.concat(marked(LAST_WRITE), all_set(new))).when(F.col("op") == "DELETE", marked(LAST_WRITE)).when((F.col("op") == "UPDATE") & (F.size(sets) + F.size(removes) > 0), patch)
    return operations.where("keys is not null").select(key_text(F.col("keys")).alias("key"), "keys", "seq", "op", F.explode(effects).alias("e")).select("key", "keys", "seq", "op", "e.*")


def apply_operations(operations: DataFrame) -> DataFrame:
    """(key, item) that the operations leave. operations: op, keys, new_image, old_image, seq (orderable, unique for a key)."""
    last = attribute_rows(operations).groupBy("key", "mark", "attr").agg(F.max_by(F.struct("seq", "op", "value", "is_set", F.map_entries("keys").alias("keys")), "seq").alias("x")).select("key", "mark", "attr", "x.*")
    of = lambda mark, what: F.max(F.when(F.col("mark") == mark, what))
    grouped = last.groupBy("key").agg(
        of(LAST_WRITE, F.struct("seq", "op")).alias("write"),
        of(LAST_UPDATE, F.col("seq")).alias("update_seq"),
        F.max(F.when(F.col("mark") == LAST_UPDATE, F.col("keys"))).alias("keys"),
        F.collect_list(F.when(F.col("mark").isNull() & F.col("is_set"), F.struct("attr", "value", "seq"))).alias("attrs"),
    )
    after = lambda seq: F.coalesce(seq >= F.col("write.seq"), F.lit(True))
    put = F.coalesce(F.col("write.op") == "PUT", F.lit(False))
    created = F.col("update_seq").isNotNull() & after(F.col("update_seq")) & ~put
    kept = F.map_from_entries(F.transform(F.filter("attrs", lambda a: after(a["seq"])), lambda a: F.struct(a["attr"].alias("key"), a["value"].alias("value"))))
    item = F.when(put, kept).when(created, F.map_concat(F.map_from_entries("keys"), kept))
    return grouped.select("key", item.alias("item")).where("item is not null")


def fold_operations(operations: DataFrame) -> DataFrame:
    """The same by folding each key's operations in order. It holds all of a key's operations at once: for small logs and as a cross-check."""
    one = "struct(seq, op, map_entries(coalesce(keys, map())) as k, map_entries(coalesce(new_image, map())) as n, map_entries(coalesce(old_image, map())) as o)"
    step = """
        aggregate(ops, cast(null as map<string,string>), (item, x) -> case
            when x.op = 'PUT' then map_from_entries(x.n)
            when x.op = 'DELETE' then cast(null as map<string,string>)
            when not exists(x.n, e -> not map_contains_key(map_from_entries(x.k), e.key))
             and not exists(x.o, e -> not map_contains_key(map_from_entries(x.k), e.key) and not map_contains_key(map_from_entries(x.n), e.key)) then item
            else map_concat(
                map_filter(coalesce(item, map_from_entries(x.k)), (a, v) -> map_contains_key(map_from_entries(x.k), a)
                    or not map_contains_key(map_from_entries(x.n), a) and not map_contains_key(map_from_entries(x.o), a)),
                map_filter(map_from_entries(x.n), (a, v) -> not map_contains_key(map_from_entries(x.k), a)))
        end)"""
    keyed = operations.where("keys is not null and op is not null").withColumn("key", key_text(F.col("keys"))).withColumn("x", F.expr(one))
    return keyed.groupBy("key").agg(F.array_sort(F.collect_list("x")).alias("ops")).select("key", F.expr(step).alias("item")).where("item is not null")


def latest_rows(rows: DataFrame, key_columns: list[str], order: list[Column], deleted: Column) -> DataFrame:
    """The last row of each key unless it is a deletion: all there is to do where no operation is an UPDATE.

    An aggregation, not a window: it combines before the shuffle.
    """
    whole = F.struct(*[F.col(c) for c in rows.columns])
    last = rows.withColumn("__deleted", deleted).groupBy(*key_columns).agg(F.max_by(F.struct(whole.alias("row"), "__deleted"), F.struct(*order)).alias("x"))
    return last.where("not x.__deleted").select("x.row.*")


def snapshot_operations(snapshot: DataFrame, seq: Column) -> DataFrame:
    """A snapshot (keys, item) as PUTs, to go before a log. seq: below all of the log's."""
    empty = F.lit(None).cast("map<string,string>")
    return snapshot.select(F.lit("PUT").alias("op"), "keys", F.col("item").alias("new_image"), empty.alias("old_image"), seq.alias("seq"))


def strict_order(operations: DataFrame) -> DataFrame:
    """Adds seq: export, write time, file, place in the file."""
    return operations.withColumn("seq", F.struct("export_ordinal", "write_micros", "file_ordinal", "block_start", "line_number"))


def batch_number(place: Column, size: int) -> Column:
    """Of the 1-based place in a file: 0 for the first `size` ones, and so on."""
    return F.floor((place - 1) / size).cast("bigint")


def batched_order(operations: DataFrame, batch_size: int = 25) -> DataFrame:
    """Adds seq: file by file and batch by batch, within a batch the UPDATEs first, as a batching writer sends them."""
    place = F.row_number().over(Window.partitionBy("export_ordinal", "file_ordinal").orderBy("block_start", "line_number"))
    return operations.withColumn("__place", place).withColumn("seq", F.struct("export_ordinal", "file_ordinal", batch_number(F.col("__place"), batch_size).alias("batch"), (F.col("op") != "UPDATE").cast("int").alias("late"), F.col("__place").alias("place"))).drop("__place")


def apply_chain(logs: list[DataFrame], order: str = "strict", batch_size: int = 25) -> DataFrame:
    """(key, item) after several exports' decoded operations, one after the other."""
    numbered = [log.withColumn("export_ordinal", F.lit(k)) for k, log in enumerate(logs)]
    whole = numbered[0]
    for log in numbered[1:]:
        whole = whole.unionByName(log)
    return apply_operations(strict_order(whole) if order == "strict" else batched_order(whole, batch_size))
