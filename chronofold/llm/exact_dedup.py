"""Exact deduplication in two Bloom passes, with DataFrame functions only.

Pass one hashes every text and counts, in each place of a filter, how often it
was hit; tasks add up their own counts first, and only places are exchanged
(8 bytes each, two for a text), neither rows nor digests. What was hit at least
twice becomes the filter's bitmap. Pass two tests each row's places: a row whose
places were not all hit twice has no equal anywhere and passes straight through.
The others - all repeated texts and a few false alarms - are shuffled by their
hash and settled exactly.

The filter has 16 bits for a row, up to `max_bits` (128 MiB) as it is broadcast;
beyond some 67 million rows in a table more rows raise false alarms and get
shuffled, and the result stays the same. Equal texts may be a third of all rows:
their group is counted with partial aggregation, and its rows are dealt over
`salts` tasks when they learn their group's outcome.

Defined results: a null text is an empty one; null ids sort below all others;
of rows equal in both id and text exactly one is kept; an empty table gives an
empty result; other columns, whatever their names, are untouched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MAX_BITS = 1 << 30
BITMAP_BITS = 32768  # of one bitmap_construct_agg() value
SALTS = 16
#: Columns of tables that hold nothing else, so no column of the documents can clash with them.
DOC, ID, SHA, ROW, HOT, KEEP, SIZE, SALT = "doc", "id", "sha", "row", "repeated", "keep", "size", "salt"


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def normalised(text: str = "text") -> Column:
    """The text with A-Z, and nothing else, in lower case."""
    return F.translate(F.coalesce(quoted(text), F.lit("")), UPPER, UPPER.lower())


def digest(text: str = "text") -> Column:
    return F.sha2(normalised(text).cast("binary"), 256)


def _positions(bits: int) -> list[Column]:
    """Two places in the filter, from separate parts of the digest."""
    return [F.conv(F.substring(SHA, at, 12), 16, 10).cast("bigint") % F.lit(bits) for at in (1, 13)]


def filter_bits(rows: int, max_bits: int = MAX_BITS) -> int:
    """A power of two, about 16 bits a row within the bound."""
    return min(max_bits, max(BITMAP_BITS, 1 << math.ceil(math.log2(max(1, rows) * 16))))


def repeated_bits(hashed: DataFrame, bits: int) -> DataFrame:
    """(bucket, bitmap): the filter's bits that were hit at least twice. At most bits / 8 bytes in all."""
    hits = hashed.select(F.explode(F.array(*_positions(bits))).alias("pos")).groupBy("pos").count().where("count > 1")
    return hits.groupBy(F.col("pos").bitwiseAND(F.lit(-BITMAP_BITS)).alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("pos").bitwiseAND(F.lit(BITMAP_BITS - 1))).alias("bitmap")
    )


def mark_repeated(hashed: DataFrame, bitmaps: DataFrame, bits: int) -> DataFrame:
    """Adds HOT: whether the row's hash is possibly repeated. Never false for a repeated one."""
    out, tests = hashed, []
    for k, pos in enumerate(_positions(bits)):
        side = bitmaps.select(F.col("bucket").alias(f"bucket{k}"), F.col("bitmap").alias(f"bitmap{k}"))
        out = out.withColumn(f"pos{k}", pos).withColumn(f"bucket{k}", F.col(f"pos{k}").bitwiseAND(F.lit(-BITMAP_BITS)))
        out = out.join(F.broadcast(side), f"bucket{k}", "left")
        tests.append(
            f"coalesce(shiftright(cast(conv(hex(substring(bitmap{k}, cast((pos{k} & {BITMAP_BITS - 1}) div 8 as int) + 1, 1)), 16, 10) as int),"
            f" cast(pos{k} & 7 as int)) & 1 = 1, false)"
        )
    return out.withColumn(HOT, F.expr(" and ".join(tests))).select(*hashed.columns, HOT)


def _settle(rows: DataFrame, salts: int) -> DataFrame:
    """Adds KEEP (id and row of the one that stays) and SIZE to possibly repeated rows."""
    groups = rows.groupBy(SHA).agg(F.max(F.struct(ID, ROW)).alias(KEEP), F.count(F.lit(1)).alias(SIZE))
    groups = groups.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn(SALT, (F.col(ROW) % salts).cast("int")).join(groups, [SHA, SALT]).drop(SALT)


def duplicate_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", max_bits: int = MAX_BITS, salts: int = SALTS) -> DataFrame:
    """One row per document: its id, keep_id, group_size, kept, text_sha256."""
    hashed = durable(docs.select(quoted(id_column).alias(ID), digest(text_column).alias(SHA), F.monotonically_increasing_id().alias(ROW)))
    bits = filter_bits(hashed.count(), max_bits)
    marked = mark_repeated(hashed, repeated_bits(hashed, bits), bits)
    outcome = lambda keep, size, kept: [F.col(ID).alias(id_column), keep.alias("keep_id"), size.cast("bigint").alias("group_size"), kept.alias("kept"), F.col(SHA).alias("text_sha256")]
    alone = marked.where(~F.col(HOT)).select(*outcome(F.col(ID), F.lit(1), F.lit(True)))
    settled = _settle(marked.where(HOT), salts).select(*outcome(F.col(f"{KEEP}.id"), F.col(SIZE), F.col(f"{KEEP}.row") == F.col(ROW)))
    return alone.unionByName(settled)


def drop_exact_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", max_bits: int = MAX_BITS, salts: int = SALTS) -> DataFrame:
    """The documents, all columns, without those that equal one of larger id. Only possibly repeated rows are shuffled."""
    groups = duplicate_groups(docs.select(quoted(id_column).alias(ID), quoted(text_column).alias("text")), ID, "text", max_bits, salts).where("group_size > 1")
    groups = durable(groups.groupBy(F.col("text_sha256").alias(SHA)).agg(F.max("keep_id").alias(KEEP)))
    bits = filter_bits(groups.count(), max_bits)
    # every text of a group: its bits count as hit twice
    bitmaps = repeated_bits(groups.select(SHA).unionAll(groups.select(SHA)), bits)
    whole = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias(DOC), quoted(id_column).alias(ID), digest(text_column).alias(SHA))
    marked = mark_repeated(whole, bitmaps, bits)
    salted = groups.select(SHA, KEEP, F.lit(1).alias(SIZE), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias(SALT))
    found = marked.where(HOT).withColumn(SALT, F.pmod(F.xxhash64(ID), F.lit(salts)).cast("int")).join(salted, [SHA, SALT], "left")
    alone = found.where(F.col(SIZE).isNull())  # a false alarm of the filter
    stays = found.where(F.col(SIZE).isNotNull() & F.col(ID).eqNullSafe(F.col(KEEP))).groupBy(SHA).agg(F.first(DOC).alias(DOC))
    return marked.where(~F.col(HOT)).select(f"{DOC}.*").unionAll(alone.select(f"{DOC}.*")).unionAll(stays.select(f"{DOC}.*"))
