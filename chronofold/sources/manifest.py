"""Export manifests: the summary, the file list, and checks of both."""

from __future__ import annotations

import re
from dataclasses import dataclass
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.operators.sink import file_system

# Field names and the format's name of the exports.
SUMMARY = (
    "version string, exportArn string, startTime string, endTime string, tableArn string, tableId string, exportTime string, exportFromTime string, exportToTime string, s3Bucket string, s3Prefix string, "
    "s3SseAlgorithm string, s3SseKmsKeyId string, manifestFilesS3Key string, billedSizeBytes bigint, itemCount bigint, outputFormat string, outputView string, exportType string"
)
FILES = "dataFileS3Key string, etag string, md5Checksum string, itemCount bigint"
FORMAT = "DYNAMODB_JSON"
SUMMARY_NAME = "manifest-summary.json"


def split_uri(uri: str) -> tuple[str, str]:
    """(bucket, key) of s3://bucket/key or s3a://...; for other paths the root and the rest."""
    if m := re.fullmatch(r"s3a?://([^/]+)/(.+)", uri):
        return m[1], m[2]
    parsed = urlparse(uri)
    if parsed.scheme in ("s3", "s3a") or not parsed.path.strip("/"):
        raise ValueError(f"not a usable URI: {uri!r}")
    return "", uri


def split_uri_column(uri: Column) -> tuple[Column, Column]:
    pattern = r"^s3a?://([^/]+)/(.+)$"
    return F.regexp_extract(uri, pattern, 1), F.regexp_extract(uri, pattern, 2)


@dataclass(frozen=True)
class Manifest:
    summary: dict
    root: str
    files: list[dict]

    @property
    def export_type(self) -> str:
        return "INCREMENTAL" if (self.summary.get("exportType") or "").startswith("INCREMENTAL") else "FULL"

    @property
    def export_id(self) -> str:
        return self.summary.get("exportArn") or self.summary["manifestFilesS3Key"]

    def path(self, key: str) -> str:
        return f"{self.root}/{key}"

    def data_paths(self, skip_empty: bool = False) -> list[tuple[int, str]]:
        """(ordinal in the manifest, path) of the data files."""
        return [(k, self.path(f["dataFileS3Key"])) for k, f in enumerate(self.files) if not (skip_empty and f["itemCount"] == 0)]


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SUMMARY).option("multiLine", True).json(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILES).json(path)


def load_manifest(spark: SparkSession, uri: str, root: str | None = None) -> Manifest:
    """The manifest at a summary's URI, or at the folder that holds it. root: what the keys in it are relative to; for an object store the bucket."""
    if not uri.endswith(".json"):
        uri = f"{uri.rstrip('/')}/{SUMMARY_NAME}"
    row = read_summary(spark, uri).first()
    if row is None or not row.manifestFilesS3Key:
        raise ValueError(f"no usable manifest summary at {uri}")
    summary = row.asDict()
    if summary["outputFormat"] not in (None, FORMAT):
        raise ValueError(f"unknown output format {summary['outputFormat']!r}")
    if root is None:
        bucket, key = split_uri(uri)
        folder = summary["manifestFilesS3Key"].rpartition("/")[0]
        root = f"{uri.split('://')[0]}://{bucket}" if bucket else uri.rpartition("/")[0].removesuffix(folder).rstrip("/")
    files = [r.asDict() for r in read_files(spark, f"{root}/{summary['manifestFilesS3Key']}").collect()]  # one row a data file
    return Manifest(summary, root, files)


def content_checksums(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, md5 in base64, bytes) of the files as they are stored."""
    read = spark.read.format("binaryFile").load(paths)
    return read.select("path", F.base64(F.unhex(F.md5("content"))).alias("md5"), F.col("length").alias("bytes"))


def verify_checksums(spark: SparkSession, manifest: Manifest) -> DataFrame:
    """(dataFileS3Key, status): ok, mismatch or missing, by the MD5 of the content; an ETag of a multipart upload isn't one."""
    paths = {f["dataFileS3Key"]: manifest.path(f["dataFileS3Key"]) for f in manifest.files}
    there = _existing(spark, sorted(set(paths.values())))
    wanted = spark.createDataFrame([(f["dataFileS3Key"], f["md5Checksum"], there.get(paths[f["dataFileS3Key"]])) for f in manifest.files], "dataFileS3Key string, expected string, path string")
    found = content_checksums(spark, sorted(there.values())) if there else spark.createDataFrame([], "path string, md5 string, bytes bigint")
    status = F.when(F.col("md5").isNull(), "missing").when(F.col("md5") == F.col("expected"), "ok").otherwise("mismatch")
    return wanted.join(found, "path", "left").select("dataFileS3Key", status.alias("status"))


def _existing(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """path -> its full name as Spark reports it, of those that are there. One listing a folder."""
    out = {}
    for folder in sorted({p.rpartition("/")[0] for p in paths}):
        fs, p = file_system(spark, folder)
        if fs.exists(p):
            names = {s.getPath().getName(): s.getPath().toString() for s in fs.listStatus(p)}
            out |= {x: names[x.rpartition("/")[2]] for x in paths if x.rpartition("/")[0] == folder and x.rpartition("/")[2] in names}
    return out


def hex_of_base64(column: Column) -> Column:
    return F.lower(F.hex(F.unbase64(column)))


def reconcile(manifest_files: DataFrame, summary_count: Column | int, decoded: DataFrame) -> DataFrame:
    """One row: items by the summary, by the file list, and as decoded. decoded: is_corrupt."""
    listed = manifest_files.agg(F.sum("itemCount").alias("listed_items"), F.count(F.lit(1)).alias("files"))
    counted = decoded.agg(F.count_if(~F.col("is_corrupt")).alias("decoded_items"), F.count_if("is_corrupt").alias("corrupt_lines"))
    expected = F.lit(summary_count) if isinstance(summary_count, int) else summary_count
    out = listed.crossJoin(counted).withColumn("summary_items", expected.cast("bigint"))  # one row each
    return out.withColumn("consistent", (F.col("summary_items") == F.col("listed_items")) & (F.col("listed_items") == F.col("decoded_items")))
