"""Seeded test exports: random items of all types, then a life of updates and deletions, written as exports with manifests."""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
from dataclasses import dataclass
from random import Random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.operators.sink import file_system, list_names

#: Names of the random attributes are one of either.
FIRST = ("river", "cedar", "amber", "north", "stone", "cloud", "ember", "frost")
SECOND = ("Height", "Colour", "Owner", "Weight", "Origin", "Season", "Shelf", "Grade")
KEYS = ("PK", "SK")
#: Secondary layouts: name -> (partition attribute, sort attribute).
INDEXES = {"by_category": ("category", "createdAt"), "by_timestamp": ("PK", "timestamp")}


@dataclass(frozen=True)
class Shape:
    items: int = 100
    updates: int = 30
    deletes: int = 20
    seed: int = 42
    indexed: bool = True


def random_value(random: Random, depth: int = 0) -> dict:
    """A tagged value, each type alike; nested ones hold scalars."""
    text = lambda: "".join(random.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(random.randint(3, 12)))
    data = lambda: base64.b64encode(random.randbytes(8)).decode()
    kinds = [
        lambda: {"S": text()}, lambda: {"N": str(random.randint(0, 1000))}, lambda: {"BOOL": random.random() < 0.5}, lambda: {"NULL": True},
        lambda: {"SS": sorted({text() for _ in range(3)})}, lambda: {"NS": [str(n) for n in sorted(random.sample(range(100), 3))]}, lambda: {"B": data()}, lambda: {"BS": sorted({data() for _ in range(2)})},
    ]
    if depth == 0:
        kinds += [lambda: {"M": {f"{random.choice(FIRST)}.{k}": random_value(random, 1) for k in range(2)}}, lambda: {"L": [random_value(random, 1) for _ in range(3)]}]
    return random.choice(kinds)()


def random_item(k: int, shape: Shape) -> dict:
    """Depends on the seed and the item's number only, so any task can make it."""
    random = Random(f"{shape.seed}:{k}")
    item = {"PK": {"S": f"ITEM#{k}"}, "SK": {"S": "METADATA"}}
    if shape.indexed:
        item |= {"timestamp": {"N": str(1_700_000_000 + k)}, "category": {"S": f"cat-{k % 5}"}, "createdAt": {"N": str(1_700_000_000 + 7 * k)}}
    for _ in range(random.randint(5, 15)):
        item[random.choice(FIRST) + random.choice(SECOND)] = random_value(random)
    return item


def full_lines(shape: Shape) -> list[str]:
    return [json.dumps({"Item": random_item(k, shape)}) for k in range(shape.items)]


def lifecycle_lines(shape: Shape, micros: int = 1_700_000_000_000_000) -> list[str]:
    """The first items are updated, the last ones deleted. Where the two overlap, an item is updated, then deleted."""
    out = []
    items = {k: random_item(k, shape) for k in {*range(shape.updates), *range(shape.items - shape.deletes, shape.items)}}
    for n, k in enumerate(range(min(shape.updates, shape.items))):
        old = items[k]
        items[k] = old | {"data": {"S": f"updated-{k}"}, "updatedAt": {"N": str(1_700_001_000 + k)}}
        out.append(_change(old, items[k], micros + n))
    for n, k in enumerate(range(max(0, shape.items - shape.deletes), shape.items)):
        out.append(_change(items[k], None, micros + shape.updates + n))
    return out


def _change(old: dict | None, new: dict | None, micros: int) -> str:
    keys = {k: (new or old)[k] for k in KEYS}
    line = {"Metadata": {"WriteTimestampMicros": {"N": str(micros)}}, "Keys": keys}
    return json.dumps(line | ({"NewImage": new} if new else {}) | ({"OldImage": old} if old else {}))


def write_export(spark: SparkSession, root: str, name: str, lines: list[str], export_type: str = "FULL", files: int = 4) -> str:
    """Writes data files and manifests as an export has them; returns the summary's path. For test sizes: the lines come from the driver."""
    folder = f"exports/{name}"
    parts = [lines[k::files] for k in range(files)]
    listed = []
    for part in parts:
        blob = gzip.compress(("\n".join(part) + ("\n" if part else "")).encode(), mtime=0)
        key = f"{folder}/data/{hashlib.sha256(name.encode() + blob + bytes([len(listed)])).hexdigest()[:26]}.json.gz"
        _put(spark, f"{root}/{key}", blob)
        listed.append({"itemCount": len(part), "md5Checksum": base64.b64encode(hashlib.md5(blob).digest()).decode(), "etag": hashlib.md5(blob).hexdigest() + "-1", "dataFileS3Key": key})
    return _write_manifest(spark, root, folder, name, listed, export_type)


def _write_manifest(spark: SparkSession, root: str, folder: str, name: str, listed: list[dict], export_type: str) -> str:
    _put(spark, f"{root}/{folder}/manifest-files.json", "".join(json.dumps(x) + "\n" for x in listed).encode())
    items = sum(x["itemCount"] for x in listed)
    summary = {"version": "2023-08-01", "exportArn": f"export/{name}", "tableArn": "table/test", "s3Bucket": "local", "s3Prefix": None, "manifestFilesS3Key": f"{folder}/manifest-files.json", "itemCount": items, "billedSizeBytes": 0, "outputFormat": "DYNAMODB_JSON"}
    if export_type != "FULL":
        summary |= {"exportType": "INCREMENTAL_EXPORT", "outputView": "NEW_AND_OLD_IMAGES"}
    _put(spark, f"{root}/{folder}/manifest-summary.json", json.dumps(summary).encode())
    return f"{root}/{folder}/manifest-summary.json"


def _put(spark: SparkSession, path: str, blob: bytes) -> None:
    """Through Hadoop's file systems, so any store that Spark writes will do."""
    fs, p = file_system(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(blob))
    finally:
        out.close()


def write_lifecycle(spark: SparkSession, root: str, shape: Shape = Shape()) -> list[str]:
    """A full export and the incremental one after it; their summaries' paths."""
    return [write_export(spark, root, "full", full_lines(shape)), write_export(spark, root, "incremental", lifecycle_lines(shape), "INCREMENTAL")]


def write_lines(lines: DataFrame, root: str, name: str, files: int = 4, export_type: str = "INCREMENTAL") -> str:
    """Writes a table of lines (line, and `part`: which of the files) as an export, by Spark's tasks; returns the summary's path."""
    from chronofold.sources.changelog import read_lines
    from chronofold.sources.manifest import content_checksums

    spark = lines.sparkSession
    folder = f"exports/{name}"
    raw = f"{root}/{folder}/raw"
    lines.select("line", (F.col("part") % files).alias("part"), *[c for c in lines.columns if c == "place"]).repartition(files, "part").sortWithinPartitions(*["part", *[c for c in lines.columns if c == "place"]]).select("line", "part").write.partitionBy("part").option("compression", "gzip").text(raw)
    paths = []
    for part in [n for n in list_names(spark, raw) if n.startswith("part=")]:
        for file in [n for n in list_names(spark, f"{raw}/{part}") if n.endswith(".gz")]:
            key = f"{folder}/data/{part.replace('=', '-')}-{file}"
            fs, source = file_system(spark, f"{raw}/{part}/{file}")
            target = file_system(spark, f"{root}/{key}")[1]
            fs.mkdirs(target.getParent())
            fs.rename(source, target)
            paths.append(key)
    sums = {r.path.rpartition("/")[2]: r.md5 for r in content_checksums(spark, [f"{root}/{k}" for k in paths]).collect()}  # one row a file
    counts = {r.file: r["count"] for r in read_lines(spark, [(k, f"{root}/{p}") for k, p in enumerate(paths)]).groupBy("file").count().collect()}
    listed = [{"itemCount": counts.get(p.rpartition("/")[2], 0), "md5Checksum": sums[p.rpartition("/")[2]], "etag": f"{k}-1", "dataFileS3Key": p} for k, p in enumerate(paths)]
    return _write_manifest(spark, root, folder, name, listed, export_type)


def index_view(items: DataFrame, index: str) -> DataFrame:
    """(partition, sort, key, place): the items that have both attributes, as a secondary index orders them."""
    from chronofold.functions.values import as_number_text, as_string, attribute
    from chronofold.operators.rank import place_in_partition

    first, second = INDEXES[index]
    out = items.select("key", as_string(attribute("item", first)).alias("partition"), as_number_text(attribute("item", second)).try_cast("bigint").alias("sort")).where("partition is not null and sort is not null")
    return place_in_partition(out, "partition", "sort", "key")
