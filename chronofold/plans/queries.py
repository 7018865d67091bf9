"""Registered queries over the driver's tables, each with its SQL oracle.

`events` is the change log: user_id is the key, event_id the order. A signup
puts an item, a purchase, click or view updates it, an error deletes it.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronofold.functions import values as v
from chronofold.operators.apply import apply_chain, apply_operations, attribute_rows, batch_number, batched_order, fold_operations, key_text, latest_rows, removes_of, sets_of, strict_order, update_expression
from chronofold.operators.decode import decode_lines, with_keys
from chronofold.operators.rank import place_in_partition
from chronofold.operators.sink import FileStore, backoff, delete, list_names, put_new, read_current, write_to_store
from chronofold.operators.verify import compare_counts, compare_tables, multiset_difference
from chronofold.sources.changelog import read_lines
from chronofold.sources.ledger import ParquetLedger, naive_pending, pending_files, totals
from chronofold.sources.manifest import hex_of_base64, load_manifest, read_files, read_summary, reconcile, split_uri_column, verify_checksums
from chronofold.streaming.apply import start

from .config import Config
from .datagen import KEYS, Shape, full_lines, index_view, write_lines
from .lifecycle import verify_lifecycle
from .report import Report, duration_text, file_counts, operation_counts, throughput
from .restore import restore

Query = Callable[[SparkSession, str], DataFrame]
_found: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _found[f.__name__] = f
        if sql:
            _sql[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_found)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _number(x: Column) -> Column:
    return v.tagged("N", x)


def operations_of(log: DataFrame, seq: Column | None = None) -> DataFrame:
    """events -> op, keys, new_image, old_image, seq."""
    user, cents, k = _number(F.col("user_id")), _number(F.round(F.col("value") * 100).cast("bigint")), _number(F.get_json_object("props", "$.k").cast("bigint"))
    kind = F.col("event_type")
    op = F.when(kind == "signup", "PUT").when(kind == "error", "DELETE").otherwise("UPDATE")
    item = lambda **named: F.create_map(*[x for name, value in named.items() for x in (F.lit(name), value)])
    user_only = item(user_id=user)
    new = (
        F.when(kind == "signup", item(user_id=user, cents=cents, k=k))
        .when(kind == "purchase", item(user_id=user, cents=cents))
        .when(kind == "click", item(user_id=user, k=k))
        .when(kind == "view", item(user_id=user, seen=cents))
    )
    old = F.when(kind == "purchase", item(user_id=user, cents=cents, k=k)).when(kind == "click", item(user_id=user, k=k)).when(kind == "view", user_only).when(kind == "error", user_only)
    return log.select(op.alias("op"), user_only.alias("keys"), new.alias("new_image"), old.alias("old_image"), (seq if seq is not None else F.col("event_id")).alias("seq"))


def _attributes(snapshot: DataFrame) -> DataFrame:
    """One row per item and attribute."""
    return snapshot.select(v.as_number_text(v.attribute("item", "user_id")).cast("bigint").alias("user_id"), F.explode("item").alias("attr", "value")).select("user_id", "attr", v.as_number_text(F.col("value")).cast("bigint").alias("number"))


#: Rows (user_id, attr, seq, number, is_set) of every effect, and the order in which operations count, over a log `l` of (event_id, user_id, event_type, value, props, seq).
EFFECTS = """
  effects AS (
    SELECT user_id, seq, 'user_id' AS attr, CAST(user_id AS BIGINT) AS number, TRUE AS is_set FROM l WHERE event_type = 'signup'
    UNION ALL SELECT user_id, seq, 'cents', CAST(round(value * 100) AS BIGINT), TRUE FROM l WHERE event_type IN ('signup', 'purchase')
    UNION ALL SELECT user_id, seq, 'k', CAST(json_extract_string(props, '$.k') AS BIGINT), TRUE FROM l WHERE event_type IN ('signup', 'click')
    UNION ALL SELECT user_id, seq, 'k', NULL, FALSE FROM l WHERE event_type = 'purchase'
    UNION ALL SELECT user_id, seq, 'seen', CAST(round(value * 100) AS BIGINT), TRUE FROM l WHERE event_type = 'view'
  ),
  base AS (SELECT user_id, max(seq) AS seq, arg_max(event_type, seq) AS kind FROM l WHERE event_type IN ('signup', 'error') GROUP BY user_id),
  patched AS (SELECT user_id, max(seq) AS seq FROM l WHERE event_type IN ('purchase', 'click', 'view') GROUP BY user_id),
  alive AS (
    SELECT DISTINCT l.user_id, coalesce(b.kind, '') AS kind FROM l LEFT JOIN base b USING (user_id) LEFT JOIN patched p USING (user_id)
    WHERE b.kind = 'signup' OR b.seq IS NULL AND p.seq IS NOT NULL OR p.seq > b.seq
  ),
  last AS (
    SELECT e.user_id, e.attr, arg_max(e.number, e.seq) AS number, arg_max(e.is_set, e.seq) AS is_set
    FROM effects e LEFT JOIN base b USING (user_id) WHERE b.seq IS NULL OR e.seq >= b.seq GROUP BY e.user_id, e.attr
  ),
  result AS (
    SELECT user_id, attr, number FROM last JOIN alive USING (user_id) WHERE is_set
    UNION ALL SELECT user_id, 'user_id', CAST(user_id AS BIGINT) FROM alive WHERE kind <> 'signup'
  )
"""
SNAPSHOT_SQL = "WITH l AS (SELECT *, event_id AS seq FROM events), " + EFFECTS + " SELECT CAST(user_id AS BIGINT) AS user_id, attr, number FROM result"


@query("SELECT CASE event_type WHEN 'signup' THEN 'PUT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS op, count(*) AS n FROM events GROUP BY 1")
def classify_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as change-log lines, decoded again, and counted by operation."""
    return decode_lines(change_lines(events(spark, sf_dir))).groupBy("op").agg(F.count(F.lit(1)).alias("n"))


def change_lines(log: DataFrame) -> DataFrame:
    """events -> (event_id, user_id, line): the JSON line of each operation."""
    ops = operations_of(log, F.struct("event_id", "user_id"))
    image = lambda m: F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), e["value"])), ","), F.lit("}"))
    field = lambda name, m: F.when(m.isNotNull(), F.concat(F.lit(f',"{name}":'), image(m))).otherwise("")
    micros = F.concat(F.lit('{"Metadata":{"WriteTimestampMicros":{"N":"'), F.col("seq.event_id").cast("string"), F.lit('"}}'))
    line = F.concat(micros, field("Keys", F.col("keys")), field("NewImage", F.col("new_image")), field("OldImage", F.col("old_image")), F.lit("}"))
    return ops.select("seq.event_id", "seq.user_id", line.alias("line"))


@query(SNAPSHOT_SQL)
def decoded_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines -> decode -> apply: the whole path of a restore."""
    return _attributes(apply_operations(decode_lines(change_lines(events(spark, sf_dir))).withColumn("seq", F.struct("write_micros", "event_id"))))


@query("SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1 AND event_type <> 'error'")
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = events(spark, sf_dir).select("user_id", "event_id", "event_type", "value", "ts")
    return latest_rows(log, ["user_id"], [F.col("ts"), F.col("event_id")], F.col("event_type") == "error").select("user_id", "event_id", "event_type", "value")


@query(SNAPSHOT_SQL)
def apply_patch_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _attributes(apply_operations(operations_of(events(spark, sf_dir))))


@query(SNAPSHOT_SQL)
def fold_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _attributes(fold_operations(operations_of(events(spark, sf_dir))))


@query("SELECT user_id, event_id, CAST(round(value * 100) AS BIGINT) AS cents FROM events WHERE event_type = 'signup' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def put_only_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    puts = events(spark, sf_dir).where("event_type = 'signup'").select("user_id", "event_id", F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    return latest_rows(puts, ["user_id"], [F.col("event_id")], F.lit(False))


_DELETES = "WITH l AS (SELECT *, event_id AS seq FROM events WHERE event_type IN ('signup', 'error')), " + EFFECTS + " SELECT CAST(user_id AS BIGINT) AS user_id, attr, number FROM result"


@query(_DELETES)
def delete_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _attributes(apply_operations(operations_of(events(spark, sf_dir).where("event_type in ('signup', 'error')"))))


@query("WITH l AS (SELECT *, event_id AS seq FROM events WHERE event_type IN ('purchase', 'click', 'view', 'error')), " + EFFECTS + " SELECT CAST(user_id AS BIGINT) AS user_id, attr, number FROM result")
def update_creates_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No puts: every item there is was made by an update."""
    return _attributes(apply_operations(operations_of(events(spark, sf_dir).where("event_type <> 'signup'"))))


@query(
    "SELECT event_type, CAST(count(*) FILTER (WHERE event_type = 'signup') AS BIGINT) AS puts, CAST(count(*) AS BIGINT) AS operations, "
    "CAST(sum(CASE event_type WHEN 'signup' THEN 4 WHEN 'error' THEN 1 WHEN 'purchase' THEN 3 ELSE 0 END) AS BIGINT) AS effects FROM events GROUP BY event_type"
)
def noop_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks and views rewritten so that they change nothing: they have no effect rows and create nothing."""
    log = events(spark, sf_dir)
    ops = operations_of(log, F.struct("event_id", "event_type"))
    still = F.col("seq.event_type").isin("click", "view")
    ops = ops.withColumn("new_image", F.when(still, F.col("keys")).otherwise(F.col("new_image"))).withColumn("old_image", F.when(still, F.col("keys")).otherwise(F.col("old_image")))
    effects = attribute_rows(ops).groupBy(F.col("seq.event_type").alias("event_type")).agg(F.count(F.lit(1)).alias("n"))
    counts = log.groupBy("event_type").agg(F.count_if(F.col("event_type") == "signup").alias("puts"), F.count(F.lit(1)).alias("operations"))
    return counts.join(effects, "event_type", "left").select("event_type", "puts", "operations", F.coalesce("n", F.lit(0)).cast("bigint").alias("effects"))


@query(
    """
    WITH x AS (SELECT event_id, user_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events),
    names(kind, attrs) AS (VALUES ('signup', ['cents', 'k']), ('purchase', ['cents']), ('click', ['k']), ('view', ['seen']), ('error', []::VARCHAR[]))
    SELECT event_id, CASE WHEN len(n.attrs) > 0 THEN 'SET ' || array_to_string(n.attrs, ', ') ELSE '' END
      || CASE WHEN len(n.attrs) > 0 AND len(list_filter(o.attrs, lambda a: NOT list_contains(n.attrs, a))) > 0 THEN ' ' ELSE '' END
      || CASE WHEN len(list_filter(o.attrs, lambda a: NOT list_contains(n.attrs, a))) > 0 THEN 'REMOVE ' || array_to_string(list_filter(o.attrs, lambda a: NOT list_contains(n.attrs, a)), ', ') ELSE '' END AS expression
    FROM x JOIN names n ON n.kind = x.event_type JOIN names o ON o.kind = x.before
    """
)
def image_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive images of a user as an update: what is set and what removed."""
    ops = operations_of(events(spark, sf_dir))
    image = F.coalesce("new_image", "keys")
    w = Window.partitionBy("keys.user_id").orderBy("seq")
    pairs = ops.select(F.col("seq").alias("event_id"), "keys", image.alias("new"), F.lag(F.map_entries(image)).over(w).alias("old")).where("old is not null")
    keys, new, old = F.col("keys"), F.col("new"), F.map_from_entries("old")
    return pairs.select("event_id", update_expression(sets_of(keys, new), removes_of(keys, new, old)).alias("expression"))


@query("SELECT user_id, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 25 AS batch, event_id FROM events")
def batch_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    return events(spark, sf_dir).select("user_id", batch_number(place, 25).alias("batch"), "event_id")


#: The log as eight files of an export: user_id modulo 8, in the order of event_id.
PLACED = "SELECT *, user_id % 8 AS file, row_number() OVER (PARTITION BY user_id % 8 ORDER BY event_id) AS place FROM events"


def _in_files(log: DataFrame, file: Column) -> DataFrame:
    """Decoded operations with the places of their lines in files; write times are as in the log."""
    ops = operations_of(log.withColumn("__file", file), F.struct("event_id", "__file"))
    zero = F.lit(0)
    return ops.select("op", "keys", "new_image", "old_image", zero.alias("export_ordinal"), F.col("seq.event_id").alias("write_micros"), F.col("seq.__file").cast("int").alias("file_ordinal"), zero.cast("bigint").alias("block_start"), F.col("seq.event_id").alias("line_number"))


@query(
    f"""
    WITH l AS (SELECT *, ((place - 1) // 25) * 100000 + CASE WHEN event_type IN ('signup', 'error') THEN 50000 ELSE 0 END + (place - 1) % 25 AS seq FROM ({PLACED})), """
    + EFFECTS
    + " SELECT CAST(user_id AS BIGINT) AS user_id, attr, number FROM result"
)
def batched_order_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each file's lines in batches of 25, within a batch the updates first."""
    return _attributes(apply_operations(batched_order(_in_files(events(spark, sf_dir), F.col("user_id") % 8), 25)))


@query(SNAPSHOT_SQL)
def strict_order_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operations dealt over files that know nothing of each other: the write time orders them."""
    return _attributes(apply_operations(strict_order(_in_files(events(spark, sf_dir), F.col("event_id") % 5))))


@query(SNAPSHOT_SQL)
def chained_exports_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two exports, one after the other, nothing written in between."""
    log = events(spark, sf_dir)
    half = log.agg((F.max("event_id") / 2).cast("bigint").alias("half"))
    log = log.crossJoin(F.broadcast(half))  # one row
    parts = [_in_files(log.where(where).drop("half"), F.col("user_id") % 8).drop("export_ordinal") for where in ("event_id <= half", "event_id > half")]
    return _attributes(apply_chain(parts))


@query(SNAPSHOT_SQL)
def full_plus_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot of the first half of the log, put before the two quarters that follow."""
    log = events(spark, sf_dir)
    bounds = log.agg((F.max("event_id") / 2).cast("bigint").alias("middle"), (F.max("event_id") * 3 / 4).cast("bigint").alias("later"))
    log = log.crossJoin(F.broadcast(bounds))  # one row
    ordinal = F.when(F.col("event_id") <= F.col("middle"), 0).when(F.col("event_id") <= F.col("later"), 1).otherwise(2)
    order = F.struct(ordinal.alias("export"), F.col("event_id"))
    base = apply_operations(operations_of(log.where("event_id <= middle"), order))
    first = base.select(F.lit("PUT").alias("op"), F.map_filter("item", lambda k, _: k == "user_id").alias("keys"), F.col("item").alias("new_image"), F.lit(None).cast("map<string,string>").alias("old_image"), F.struct(F.lit(-1).alias("export"), F.lit(0).cast("bigint").alias("event_id")).alias("seq"))
    return _attributes(apply_operations(first.unionByName(operations_of(log.where("event_id > middle"), order))))


_FILES = "SELECT 'data/' || md5(user_id) || '.json.gz' AS dataFileS3Key, CAST(count(*) AS BIGINT) AS itemCount, user_id FROM (SELECT CAST(user_id AS VARCHAR) AS user_id FROM events) GROUP BY user_id"


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file list: one file a user."""
    name = F.concat(F.lit("data/"), F.md5(F.col("user_id").cast("string").cast("binary")), F.lit(".json.gz"))
    return events(spark, sf_dir).groupBy(name.alias("dataFileS3Key"), "user_id").agg(F.count(F.lit(1)).alias("itemCount"))


@query(f"SELECT dataFileS3Key, itemCount FROM ({_FILES}) f WHERE CAST(user_id AS BIGINT) % 3 <> 0")
def ledger_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files that a ledger of every third user's file leaves."""
    files = _files(spark, sf_dir)
    done = files.where("user_id % 3 = 0").select(F.lit("e1").alias("export_id"), F.col("dataFileS3Key").alias("file"))
    other = files.select(F.lit("e2").alias("export_id"), F.col("dataFileS3Key").alias("file"))
    return pending_files(files.select("dataFileS3Key", "itemCount"), done.unionByName(other), "e1")


@query(f"SELECT dataFileS3Key, itemCount FROM ({_FILES}) f WHERE dataFileS3Key < (SELECT dataFileS3Key FROM ({_FILES}) g ORDER BY CAST(user_id AS BIGINT) LIMIT 1)")
def naive_resume_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After the first file, by user, is done: what resuming by file name would skip although it is unread."""
    files = _files(spark, sf_dir)
    last = files.agg(F.min_by("dataFileS3Key", "user_id").alias("last")).first().last
    unread = files.where(F.col("dataFileS3Key") != last).select("dataFileS3Key", "itemCount")
    return unread.join(naive_pending(unread, last), "dataFileS3Key", "left_anti")


#: A line's damage by its event's number modulo 10, and what it then is.
_DAMAGE = "CASE event_id % 10 WHEN 1 THEN 'cut' WHEN 2 THEN 'trailing' WHEN 3 THEN 'quotes' WHEN 4 THEN 'empty' ELSE 'none' END"


@query(f"SELECT {_DAMAGE} AS damage, count(*) AS lines, count(*) FILTER (WHERE event_id % 10 IN (1, 2, 3, 4)) AS corrupt FROM events GROUP BY 1")
def corrupt_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = change_lines(events(spark, sf_dir)).withColumn("damage", F.expr(_DAMAGE))
    line, damage = F.col("line"), F.col("damage")
    broken = F.when(damage == "cut", F.expr("left(line, length(line) - 1)")).when(damage == "trailing", F.concat(line, F.lit(" {}"))).when(damage == "quotes", F.translate(line, '"', "'")).when(damage == "empty", "").otherwise(line)
    return decode_lines(lines.withColumn("line", broken)).groupBy("damage").agg(F.count(F.lit(1)).alias("lines"), F.count_if("is_corrupt").alias("corrupt"))


@query(f"WITH f AS ({_FILES}) SELECT CAST(count(*) AS BIGINT) AS files, CAST(sum(itemCount) AS BIGINT) AS listed_items, (SELECT count(*) FROM events) AS decoded_items, CAST(0 AS BIGINT) AS corrupt_lines, (SELECT count(*) FROM events) AS summary_items, TRUE AS consistent FROM f")
def manifest_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = events(spark, sf_dir)
    files, decoded = _files(spark, sf_dir), decode_lines(change_lines(log))
    out = reconcile(files, F.lit(None).cast("bigint"), decoded).drop("summary_items", "consistent").crossJoin(log.agg(F.count(F.lit(1)).alias("summary_items")))  # one row each
    return out.withColumn("consistent", (F.col("summary_items") == F.col("listed_items")) & (F.col("listed_items") == F.col("decoded_items")))


_STATE = "SELECT user_id, event_id, event_type, value FROM {log} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1 AND event_type <> 'error'"


@query(
    f"WITH early AS (SELECT * FROM events WHERE event_id <= (SELECT max(event_id) // 2 FROM events)), a AS ({_STATE.format(log='early')}), b AS ({_STATE.format(log='events')}) "
    "SELECT coalesce(a.user_id, b.user_id) AS user_id, CASE WHEN b.user_id IS NULL THEN 'missing' WHEN a.user_id IS NULL THEN 'extra' ELSE 'changed' END AS status "
    "FROM a FULL JOIN b ON a.user_id = b.user_id WHERE a.user_id IS NULL OR b.user_id IS NULL OR a.event_id <> b.event_id"
)
def verify_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after half the log against that after all of it."""
    a, b = _states(spark, sf_dir)
    return compare_tables(a, b).select(F.col("key").cast("bigint").alias("user_id"), "status")


def _states(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    log = events(spark, sf_dir)
    middle = log.agg((F.max("event_id") / 2).cast("bigint").alias("middle"))
    early = log.crossJoin(F.broadcast(middle)).where("event_id <= middle").drop("middle")  # one row
    state = lambda x: latest_rows(x.select("user_id", "event_id", "event_type", "value"), ["user_id"], [F.col("event_id")], F.col("event_type") == "error")
    item = F.create_map(F.lit("event"), _number(F.col("event_id")), F.lit("type"), v.tagged("S", F.col("event_type")))
    return tuple(state(x).select(F.col("user_id").cast("string").alias("key"), item.alias("item")) for x in (early, log))


@query(f"WITH early AS (SELECT * FROM events WHERE event_id <= (SELECT max(event_id) // 2 FROM events)), a AS ({_STATE.format(log='early')}), b AS ({_STATE.format(log='events')}) SELECT (SELECT count(*) FROM a) AS expected, (SELECT count(*) FROM b) AS actual, (SELECT count(*) FROM a) = (SELECT count(*) FROM b) AS equal")
def verify_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_counts(*_states(spark, sf_dir))


@query(
    "SELECT event_type, side, count(*) AS n FROM (SELECT event_type, user_id, 'source' AS side FROM (SELECT event_type, user_id FROM events WHERE event_id % 2 = 0 EXCEPT ALL SELECT event_type, user_id FROM events WHERE event_id % 2 = 1) "
    "UNION ALL SELECT event_type, user_id, 'target' FROM (SELECT event_type, user_id FROM events WHERE event_id % 2 = 1 EXCEPT ALL SELECT event_type, user_id FROM events WHERE event_id % 2 = 0)) GROUP BY 1, 2"
)
def multiset_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir)
    side = lambda k: rows.where(F.col("event_id") % 2 == k).select("event_type", "user_id")
    return multiset_difference(side(0), side(1)).groupBy("event_type", "side").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, CAST(round(value * 100) AS BIGINT) AS cents, event_type AS kind, event_type = 'error' AS failed, list_sort(list_distinct([event_type, 'x']))[1] AS first_of_set, CAST(json_extract_string(props, '$.k') AS BIGINT) AS nested, md5(event_type) AS bytes_md5 FROM events")
def typed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged values of several types, made and read back."""
    log = events(spark, sf_dir)
    kind = F.col("event_type")
    item = F.create_map(
        F.lit("a.number"), _number(F.round(F.col("value") * 100).cast("bigint")), F.lit("kind"), v.tagged("S", kind), F.lit("failed"), v.tagged("BOOL", kind == "error"),
        F.lit("set"), F.to_json(F.struct(F.array_distinct(F.array(kind, F.lit("x"))).alias("SS"))), F.lit("map"), F.concat(F.lit('{"M":{"k":{"N":"'), F.get_json_object("props", "$.k"), F.lit('"}}}')), F.lit("bytes"), v.tagged("B", kind.cast("binary")),
    )
    x = log.select("event_id", item.alias("item"))
    of = lambda name: v.attribute("item", name)
    return x.select(
        "event_id", v.as_number_text(of("a.number")).cast("bigint").alias("cents"), v.as_string(of("kind")).alias("kind"), v.as_boolean(of("failed")).alias("failed"),
        v.as_string_set(of("set"))[0].alias("first_of_set"), v.as_number_text(v.as_map(of("map"))["k"]).cast("bigint").alias("nested"), F.md5(v.as_binary(of("bytes"))).alias("bytes_md5"),
    )


@query(
    "SELECT tag, attr, count(*) AS n FROM (SELECT 'N' AS tag, 'user_id' AS attr FROM events WHERE event_type <> 'error' UNION ALL SELECT 'N', 'cents' FROM events WHERE event_type IN ('signup', 'purchase') "
    "UNION ALL SELECT 'N', 'k' FROM events WHERE event_type IN ('signup', 'click') UNION ALL SELECT 'N', 'seen' FROM events WHERE event_type = 'view') GROUP BY 1, 2"
)
def tag_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    ops = operations_of(events(spark, sf_dir))
    return ops.select(F.explode("new_image").alias("attr", "value")).groupBy(v.tag(F.col("value")).alias("tag"), "attr").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) AS items, round(count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6), 6) AS per_second FROM events")
def throughput_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = (F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))) / 1e6
    r = events(spark, sf_dir).agg(F.count(F.lit(1)).alias("items"), seconds.alias("seconds")).first()  # one row
    return spark.createDataFrame([(r["items"], round(throughput(r["items"], r.seconds), 6))], "items bigint, per_second double")


@query("SELECT event_type AS partition, user_id, event_id, row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) AS place FROM events")
def gsi_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as a global index orders it: by another partition attribute. Five large partitions, each placed by many tasks."""
    rows = events(spark, sf_dir).select(F.col("event_type").alias("partition"), "user_id", "event_id", "value")
    return place_in_partition(rows, "partition", "value", "event_id").drop("value")


@query("SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place FROM events")
def lsi_by_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As a local index orders it: the same partitions, latest first."""
    return place_in_partition(events(spark, sf_dir).select("user_id", "event_id", "ts"), "user_id", "ts", "event_id", descending=True).drop("ts")


@query("SELECT 'cat-' || (user_id % 5) AS partition, CAST(event_id AS VARCHAR) AS key, row_number() OVER (PARTITION BY user_id % 5 ORDER BY 7 * user_id, CAST(event_id AS VARCHAR)) AS place FROM events WHERE event_type <> 'error'")
def index_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items as the generator makes them, through its index; those without an index attribute aren't in it."""
    user = F.col("user_id")
    item = F.create_map(F.lit("category"), v.tagged("S", F.concat(F.lit("cat-"), (user % 5).cast("string"))), F.lit("createdAt"), _number(7 * user))
    less = F.when(F.col("event_type") == "error", F.map_filter(item, lambda k, _: k != "category")).otherwise(item)
    return index_view(events(spark, sf_dir).select(F.col("event_id").cast("string").alias("key"), less.alias("item")), "by_category").select("partition", "key", "place")


@query("SELECT event_id, md5(props) AS digest FROM events")
def md5_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MD5 -> base64, as manifests hold it -> hex."""
    return events(spark, sf_dir).select("event_id", hex_of_base64(F.base64(F.unhex(F.md5(F.col("props").cast("binary"))))).alias("digest"))


@query("SELECT event_id, 'bucket-' || event_type AS bucket, 'exports/' || CAST(user_id AS VARCHAR) || '/manifest-summary.json' AS key FROM events")
def uri_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = F.concat(F.lit("s3://bucket-"), F.col("event_type"), F.lit("/exports/"), F.col("user_id").cast("string"), F.lit("/manifest-summary.json"))
    bucket, key = split_uri_column(uri)
    return events(spark, sf_dir).select("event_id", bucket.alias("bucket"), key.alias("key"))


@query("SELECT CAST(user_id AS VARCHAR) AS file, CAST(count(*) FILTER (WHERE event_id % 10 <> 3) AS BIGINT) AS items, CAST(count(*) FILTER (WHERE event_id % 10 = 3) AS BIGINT) AS corrupt, CAST(ceil(count(*) FILTER (WHERE event_id % 10 <> 3) / 25.0) AS BIGINT) AS batches FROM events GROUP BY user_id")
def operation_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file a user, some lines of it damaged: its operations of all kinds fill batches together."""
    lines = change_lines(events(spark, sf_dir)).withColumn("line", F.when(F.col("event_id") % 10 == 3, F.translate("line", '"', "'")).otherwise(F.col("line")))
    return file_counts(operation_counts(decode_lines(lines.withColumn("file", F.col("user_id").cast("string")))), 25)


@query("SELECT CASE WHEN event_id % 4 = 0 THEN 'key attributes are missing' ELSE 'PUT' END AS outcome, count(*) AS n, sum(CASE WHEN event_id % 4 = 0 THEN 0 ELSE event_id END)::BIGINT AS checksum FROM events GROUP BY 1")
def full_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a full export, which bring items without keys; some lack a key attribute and are corrupt."""
    keyed = F.when(F.col("event_id") % 4 == 0, F.lit("")).otherwise(F.concat(F.lit(',"sk":{"N":"'), F.col("user_id").cast("string"), F.lit('"}')))
    line = F.concat(F.lit('{"Item":{"pk":{"N":"'), F.col("event_id").cast("string"), F.lit('"}'), keyed, F.lit("}}"))
    found = with_keys(decode_lines(events(spark, sf_dir).select(line.alias("line"))), ["pk", "sk"])
    number = v.as_number_text(v.attribute("keys", "pk")).cast("bigint")
    return found.groupBy(F.coalesce("reason", "op").alias("outcome")).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(number), F.lit(0)).alias("checksum"))


def _scratch(spark: SparkSession) -> str:
    """A new folder that all executors share: in the checkpoint folder. Only where none is set (one machine, tests) a temporary one."""
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or (tempfile.mkdtemp(prefix="chronofold-") if sc.master.startswith("local[") or sc.master == "local" else None)
    if not folder:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{folder}/export-{uuid.uuid4().hex}"


def _export(spark: SparkSession, sf_dir: str, files: int = 6, damaged: int = 0) -> tuple[str, str]:
    """(root, summary's path): the log written as an incremental export, line i in the file of its user; every `damaged`-th line is cut short."""
    lines = change_lines(events(spark, sf_dir))
    line = F.when(F.col("event_id") % damaged == 0, F.expr("left(line, length(line) - 1)")).otherwise(F.col("line")) if damaged else F.col("line")
    root = _scratch(spark)
    return root, write_lines(lines.select(line.alias("line"), F.col("user_id").alias("part"), F.col("event_id").alias("place")), root, "log", files)


@query("SELECT count(*) AS \"itemCount\", 'DYNAMODB_JSON' AS \"outputFormat\", 'INCREMENTAL_EXPORT' AS \"exportType\", 'NEW_AND_OLD_IMAGES' AS \"outputView\" FROM events")
def manifest_summary_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export's summary as it lies in storage."""
    return read_summary(spark, _export(spark, sf_dir)[1]).select("itemCount", "outputFormat", "exportType", "outputView")


@query("SELECT CAST(count(DISTINCT user_id % 6) AS BIGINT) AS files, CAST(count(*) AS BIGINT) AS items, TRUE AS distinct_names FROM events")
def manifest_files_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export's file list as it lies in storage."""
    root, path = _export(spark, sf_dir)
    files = read_files(spark, f"{root}/{read_summary(spark, path).first().manifestFilesS3Key}")
    return files.agg(F.count(F.lit(1)).alias("files"), F.sum("itemCount").alias("items"), (F.count_distinct("dataFileS3Key") == F.count(F.lit(1))).alias("distinct_names"))


@query("SELECT event_id, user_id FROM (SELECT event_id, user_id FROM events)")
def data_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of an export's gzipped data files."""
    manifest = load_manifest(spark, _export(spark, sf_dir)[1])
    found = decode_lines(read_lines(spark, manifest.data_paths()))
    return found.select(F.col("write_micros").alias("event_id"), v.as_number_text(v.attribute("keys", "user_id")).cast("bigint").alias("user_id"))


@query("SELECT CASE k WHEN 0 THEN 'mismatch' WHEN 1 THEN 'missing' ELSE 'ok' END AS status, CAST(count(*) AS BIGINT) AS n FROM (SELECT row_number() OVER (ORDER BY p) - 1 AS k FROM (SELECT DISTINCT user_id % 6 AS p FROM events)) GROUP BY 1")
def checksum_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of an export's files one is changed and one deleted after they were listed."""
    root, path = _export(spark, sf_dir)
    manifest = load_manifest(spark, path)
    changed, gone = (manifest.path(f["dataFileS3Key"]) for f in manifest.files[:2])
    delete(spark, changed)
    put_new(spark, changed, b"other")
    delete(spark, gone)
    return verify_checksums(spark, manifest).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(SNAPSHOT_SQL)
def restored_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole restore, from the files of an export to the table, decoded in steps that the ledger keeps."""
    root, path = _export(spark, sf_dir)
    config = Config("t", path, ("user_id",), "INCREMENTAL", resume=f"{root}/ledger", files_per_step=2)
    return _attributes(restore(spark, config, f"{root}/table").snapshot)


@query(
    "SELECT CAST(count(*) FILTER (WHERE event_id % 7 <> 0) AS BIGINT) AS items, CAST(count(*) FILTER (WHERE event_id % 7 = 0) AS BIGINT) AS corrupt, CAST(0 AS BIGINT) AS errors, "
    "(SELECT CAST(sum(ceil(n / 25.0)) AS BIGINT) FROM (SELECT count(*) AS n FROM events WHERE event_id % 7 <> 0 GROUP BY user_id % 6)) AS batches, CAST(count(*) FILTER (WHERE event_id % 7 <> 0 AND event_type = 'signup') AS BIGINT) AS puts FROM events"
)
def restore_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a restore of an export with damaged lines, as it was written."""
    root, path = _export(spark, sf_dir, damaged=7)
    restore(spark, Config("t", path, ("user_id",), "INCREMENTAL", report=f"{root}/report"), f"{root}/table")
    text = spark.read.text(f"{root}/report", wholetext=True).withColumn("r", F.from_json("value", "totalItems bigint, corruptCount bigint, errors bigint, batches bigint, byOperation map<string,bigint>"))
    return text.select(F.col("r.totalItems").alias("items"), F.col("r.corruptCount").alias("corrupt"), "r.errors", "r.batches", F.try_element_at("r.byOperation", F.lit("PUT")).alias("puts"))


@query("SELECT 'done' AS state, CAST(count(DISTINCT user_id % 6) AS BIGINT) AS files, CAST(count(*) AS BIGINT) AS items FROM events UNION ALL SELECT 'staged', CAST(count(DISTINCT user_id % 6) AS BIGINT), CAST(count(*) AS BIGINT) FROM events")
def ledger_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a restore in steps has entered into the ledger."""
    root, path = _export(spark, sf_dir)
    restore(spark, Config("t", path, ("user_id",), "INCREMENTAL", resume=f"{root}/ledger", files_per_step=4), f"{root}/table")
    return ParquetLedger(spark, f"{root}/ledger").read().groupBy("state").agg(F.count(F.lit(1)).alias("files"), F.sum("items").alias("items"))


@query(SNAPSHOT_SQL)
def resumed_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that dies after its first step, and the one that goes on from there."""
    root, path = _export(spark, sf_dir)
    config = Config("t", path, ("user_id",), "INCREMENTAL", files_per_step=2, tries=1)

    class Dying(ParquetLedger):
        left = 1

        def append(self, rows: DataFrame) -> None:
            if not self.left:
                raise OSError("the run dies")
            self.left -= 1
            super().append(rows)

    try:
        restore(spark, config, f"{root}/table", Dying(spark, f"{root}/ledger"))
    except OSError:
        pass
    return _attributes(restore(spark, config, f"{root}/table", ParquetLedger(spark, f"{root}/ledger")).snapshot)


@query("SELECT CAST(0 AS BIGINT) AS tables, CAST(count(*) AS BIGINT) AS items FROM events")
def dry_run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dry run decodes and counts, and leaves nothing."""
    root, path = _export(spark, sf_dir)
    report = restore(spark, Config("t", path, ("user_id",), "INCREMENTAL", dry_run=True), f"{root}/table").report
    return spark.createDataFrame([(len(list_names(spark, f"{root}/table")), report.total_items)], "tables bigint, items bigint")


@query(SNAPSHOT_SQL)
def stored_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log sent to an outside store in batches and single updates; what the store then holds."""
    root = _scratch(spark)
    put_new(spark, f"{root}/store/_made", b"")
    empty = F.create_map().cast("map<string,string>")
    ops = operations_of(events(spark, sf_dir)).select(key_text(F.col("keys")).alias("key"), "op", F.col("keys").alias("keys_of"), F.coalesce("new_image", empty).alias("new_image"), F.coalesce("old_image", empty).alias("old_image"), "seq")
    folder = re.sub("^file:/+", "/", f"{root}/store")
    write_to_store(ops, lambda: FileStore(folder), 25)
    return _attributes(spark.read.schema("key string, item map<string,string>").json(f"{root}/store"))


@query(SNAPSHOT_SQL)
def streamed_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export's files as a stream, two at a time, each applied once to the kept table. All of a user's lines are in one file."""
    root, path = _export(spark, sf_dir)
    start(spark, f"{root}/exports/log/data", f"{root}/table", f"{root}/checkpoint", ["user_id"], files_per_batch=2, once=True).awaitTermination()
    return _attributes(read_current(spark, f"{root}/table"))


@query("SELECT 'cat-' || k AS category, CAST(20 AS BIGINT) AS items, CAST(20 AS BIGINT) AS keyed FROM range(5) t(k)")
def generated_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generator's hundred items: five categories of twenty, each item with keys and index attributes."""
    shape = Shape()
    lines = spark.createDataFrame([(x,) for x in full_lines(shape)], "line string")
    found = with_keys(decode_lines(lines), list(KEYS))
    category = v.as_string(v.attribute("new_image", "category"))
    return found.groupBy(category.alias("category")).agg(F.count(F.lit(1)).alias("items"), F.count("keys").alias("keyed"))


@query("SELECT phase, TRUE AS ok FROM (VALUES ('generate'), ('full export'), ('lifecycle'), ('incremental export'), ('checksums'), ('restore full'), ('restore incremental'), ('counts'), ('differences')) t(phase)")
def lifecycle_phases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify_lifecycle(spark, _scratch(spark)).select("phase", "ok")


@query("SELECT CAST(k AS BIGINT) AS attempt, least(30.0, 0.1 * 2 ** least(k, 30))::DOUBLE AS least_seconds, 2 * least(30.0, 0.1 * 2 ** least(k, 30))::DOUBLE AS most_seconds FROM range(40) t(k)")
def backoff_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(k, backoff(k, lambda: 0.0), backoff(k, lambda: 1.0)) for k in range(40)], "attempt bigint, least_seconds double, most_seconds double")


@query("SELECT * FROM (VALUES ('table', FALSE), ('export', FALSE), ('export_type', FALSE), ('view', FALSE), ('region', FALSE), ('workers', FALSE), ('batch_size', FALSE), ('report', FALSE), ('shutdown_timeout', FALSE), ('none', TRUE)) t(broken, accepted)")
def configuration_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A configuration that is right, and one with each of its parts broken."""
    good = dict(table="t", export="s3://b/k", local=False, region="r")
    broken = dict(table="", export="http://x/y", export_type="full", view="new", region="", workers=0, batch_size=26, report="x", shutdown_timeout=0.5, none=None)

    def accepted(name: str) -> bool:
        try:
            Config(**good | ({} if name == "none" else {name: broken[name]}))
        except ValueError:
            return False
        return True

    return spark.createDataFrame([(name, accepted(name)) for name in broken], "broken string, accepted boolean")


@query("SELECT CAST(event_id % 3 AS INT) AS kind, count(*) AS n FROM events WHERE event_id % 3 = 2 GROUP BY 1")
def deep_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items nested six deep: written otherwise but equal (kind 0 and 1: sets in another order, 1.0 for 1), or unlike (kind 2)."""
    nested = lambda inner: F.concat(F.lit('{"M":{"a":{"L":[{"M":{"b":{"M":{"c":{"L":['), inner, F.lit("]}}}}}]}}}"))
    k = F.col("event_id") % 3
    number = F.col("user_id").cast("string")
    left = F.concat(F.lit('{"SS":["x","y"]},{"N":"'), number, F.lit('"}'))
    right = F.when(k == 0, F.concat(F.lit('{"SS":["y","x"]},{"N":"'), number, F.lit('"}'))).when(k == 1, F.concat(F.lit('{"SS":["x","y"]},{"N":"'), number, F.lit('.0"}'))).otherwise(F.concat(F.lit('{"SS":["x","z"]},{"N":"'), number, F.lit('"}')))
    side = lambda inner: events(spark, sf_dir).select(F.col("event_id").cast("string").alias("key"), F.create_map(F.lit("m"), nested(inner)).alias("item"))
    found = compare_tables(side(left), side(right))
    return found.groupBy((F.col("key").cast("bigint") % 3).cast("int").alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CAST(count(DISTINCT user_id % 6) AS BIGINT) AS files, CAST(count(*) FILTER (WHERE event_id % 9 <> 0) AS BIGINT) AS items, CAST(count(*) FILTER (WHERE event_id % 9 = 0) AS BIGINT) AS corrupt FROM events")
def progress_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ledger says of an export so far, whether its files are staged or done."""
    root, path = _export(spark, sf_dir, damaged=9)
    restore(spark, Config("t", path, ("user_id",), "INCREMENTAL", files_per_step=3), f"{root}/table", ledger := ParquetLedger(spark, f"{root}/ledger"))
    return totals(ledger.read(), load_manifest(spark, path).export_id)


@query("SELECT * FROM (VALUES (0.25::DOUBLE, '0.25s'), (59.0, '59s'), (60.0, '1m0s'), (61.5, '1m1.5s'), (3600.0, '1h0m0s'), (3723.125, '1h2m3.125s'), (90061.0, '25h1m1s')) t(seconds, shown)")
def duration_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(x, duration_text(x)) for x in (0.25, 59.0, 60.0, 61.5, 3600.0, 3723.125, 90061.0)], "seconds double, shown string")


@query(
    "SELECT name, value FROM (SELECT CAST(count(*) AS VARCHAR) AS total_items, '0' AS corrupt_count, '0' AS errors, (SELECT CAST(CAST(sum(ceil(n / 10.0)) AS BIGINT) AS VARCHAR) FROM (SELECT count(*) AS n FROM events GROUP BY user_id % 6)) AS batches FROM events) "
    "UNPIVOT (value FOR name IN (total_items, corrupt_count, errors, batches))"
)
def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a restore as it is printed, in batches of ten."""
    root, path = _export(spark, sf_dir)
    said = restore(spark, Config("t", path, ("user_id",), "INCREMENTAL", batch_size=10), f"{root}/table").report.as_text()
    rows = [tuple(line.split(": ", 1)) for line in said.splitlines()]
    return spark.createDataFrame([r for r in rows if r[0] in ("total_items", "corrupt_count", "errors", "batches")], "name string, value string")


@query("SELECT event_type AS kind, count(*) AS n FROM events WHERE event_type <> 'view' GROUP BY 1")
def other_decoder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A restore with parts of its own: a decoder that counts views as corrupt, and an uploader that keeps the report's counts."""
    root, path = _export(spark, sf_dir)
    kept: dict[str, int] = {}

    def decode(lines: DataFrame) -> DataFrame:
        found = decode_lines(lines)
        seen = F.coalesce(F.map_contains_key("new_image", F.lit("seen")), F.lit(False))
        return found.withColumn("is_corrupt", F.col("is_corrupt") | seen).withColumn("op", F.when(~seen, F.col("op")))

    def upload(_: SparkSession, report: Report, uri: str) -> None:
        kept.update(report.by_op)

    table = restore(spark, Config("t", path, ("user_id",), "INCREMENTAL", report="kept"), f"{root}/table", decode=decode, upload=upload)
    if table.report.corrupt_count != kept["CORRUPT"]:
        raise ValueError("the report and what was uploaded differ")
    manifest = load_manifest(spark, path)
    names = {"signup": "PUT", "error": "DELETE"}
    kinds = decode(read_lines(spark, manifest.data_paths())).where("not is_corrupt").select(F.col("write_micros").alias("event_id"), "op")
    log = events(spark, sf_dir).select("event_id", F.col("event_type").alias("kind"))
    right = F.coalesce(F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[F.col("kind")], F.lit("UPDATE")) == F.col("op")
    return kinds.join(log, "event_id").where(right).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
