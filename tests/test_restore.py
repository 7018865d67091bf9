"""Exports end to end: manifests, ledger, dry run, resume, verification, sinks, streaming, command line."""

import os

import pytest
from pyspark.sql import functions as F

from chronofold.operators import sink
from chronofold.operators.sink import read_current
from chronofold.operators.verify import compare_counts, compare_tables
from chronofold.plans import cli
from chronofold.plans.config import Config
from chronofold.plans.datagen import KEYS, Shape, index_view, random_item, write_lifecycle
from chronofold.plans.report import duration_text, throughput
from chronofold.plans.restore import decode_export, restore
from chronofold.sources.ledger import ParquetLedger, naive_pending, pending_files
from chronofold.sources.manifest import load_manifest, split_uri, verify_checksums

GOOD = dict(table="t", export="s3://b/k", local=False, region="r")


@pytest.mark.parametrize(
    "bad", [{"table": ""}, {"export": ""}, {"export": "http://x/y"}, {"export_type": "full"}, {"view": "new"}, {"region": ""}, {"workers": 0}, {"batch_size": 0}, {"batch_size": -1}, {"batch_size": 26}, {"report": "x"}, {"shutdown_timeout": 0.5}]
)
def test_config_rejects(bad):
    with pytest.raises(ValueError):
        Config(**GOOD | bad)


@pytest.mark.parametrize("good", [{}, {"batch_size": 1}, {"batch_size": 25}, {"report": "s3://b/r"}, {"shutdown_timeout": 1}])
def test_config_accepts(good):
    Config(**GOOD | good)


def test_uris():
    assert split_uri("s3://bucket/a/b.json") == ("bucket", "a/b.json") == split_uri("s3a://bucket/a/b.json")
    for bad in ("s3://", "s3://bucket", "s3:///x", ""):
        with pytest.raises(ValueError):
            split_uri(bad)


@pytest.fixture(scope="module")
def exports(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("exports"))
    return root, write_lifecycle(spark, root, Shape(items=60, updates=20, deletes=15))


def test_manifest_and_checksums(spark, exports):
    root, (full, _) = exports
    m = load_manifest(spark, full)
    assert m.root == root and m.export_type == "FULL" and len(m.files) == 4 and sum(f["itemCount"] for f in m.files) == 60
    assert {r.status for r in verify_checksums(spark, m).collect()} == {"ok"}
    assert load_manifest(spark, os.path.dirname(full)).summary == m.summary


def test_restore_chain_dry_run_resume_and_verify(spark, exports, tmp_path):
    _, (full, incremental) = exports
    target, resume = str(tmp_path / "table"), str(tmp_path / "ledger")
    config = lambda export, **more: Config("t", export, KEYS, resume=resume, **more)
    dry = restore(spark, config(full, dry_run=True), target)
    assert dry.report.total_items == 60 and dry.snapshot is None and not os.path.exists(target) and not os.path.exists(resume)
    first = restore(spark, config(full, report=str(tmp_path / "report")), target)
    assert first.snapshot.count() == 60 and not first.report.warnings and "totalItems" in first.report.as_json()
    again = restore(spark, config(full), target)
    assert again.report.total_items == 0 and again.snapshot.count() == 60
    second = restore(spark, config(incremental, export_type="INCREMENTAL", view="NEW_AND_OLD"), target)
    assert second.report.by_op == {"UPDATE": 20, "DELETE": 15} and second.snapshot.count() == 45
    for order in ("strict", "batched"):
        other = str(tmp_path / f"other-{order}")
        restore(spark, Config("t", full, KEYS, order=order), other)
        restore(spark, Config("t", incremental, KEYS, "INCREMENTAL", order=order), other)
        assert compare_tables(read_current(spark, target), read_current(spark, other)).count() == 0
    assert compare_counts(first.snapshot, read_current(spark, target), 15).first().equal
    changed = read_current(spark, target).withColumn("item", F.map_concat(F.map_filter("item", lambda k, _: k != "updatedAt"), F.create_map(F.lit("updatedAt"), F.lit('{"N":"0"}'))))
    assert {r.status for r in compare_tables(read_current(spark, target), changed).collect()} == {"changed"}
    assert {r["place"] for r in index_view(read_current(spark, target), "by_category").collect()} == set(range(1, 10))


def test_resume_takes_files_that_name_order_would_skip(spark):
    files = spark.createDataFrame([("zq", 0), ("5m", 3), ("t7", 0), ("er", 0)], "dataFileS3Key string, itemCount bigint")
    done = spark.createDataFrame([("e1", "zq"), ("e2", "5m")], "export_id string, file string")
    assert sorted(r.dataFileS3Key for r in pending_files(files, done, "e1").collect()) == ["5m", "er", "t7"]
    assert [r.dataFileS3Key for r in naive_pending(files, "zq").collect()] == ["zq"]


def test_missing_ledger_is_empty_and_needs_a_path(spark, tmp_path):
    assert ParquetLedger(spark, str(tmp_path / "none")).read().count() == 0
    with pytest.raises(ValueError):
        ParquetLedger(spark, "")


def test_corrupt_lines_are_counted_or_fail(spark, tmp_path):
    from chronofold.plans.datagen import full_lines, write_export

    path = write_export(spark, str(tmp_path), "broken", [*full_lines(Shape(items=5)), "oops", '{"Item":{}} x'])
    result = restore(spark, Config("t", path, KEYS), str(tmp_path / "t"))
    assert (result.report.total_items, result.report.corrupt_count, result.snapshot.count()) == (5, 2, 5) and result.report.warnings
    with pytest.raises(ValueError):
        restore(spark, Config("t", path, KEYS, on_corrupt="fail"), str(tmp_path / "u"))
    assert decode_export(spark, load_manifest(spark, path), list(KEYS)).where("is_corrupt").count() == 2


def test_backoff_and_retries():
    assert [sink.backoff(k, lambda: 0) for k in (0, 1, 8, 9, 500)] == [0.1, 0.2, 25.6, 30.0, 30.0]
    taken, waits = [], []

    def send(batch):
        if len(waits) < 3:
            raise sink.Throttled
        taken.append(batch[0])
        return batch[1:]

    sink.write_with_retries(send, [1, 2, 3], waits.append)
    assert taken == [1, 2, 3] and len(waits) == 5
    calls = []

    def broken(batch):
        calls.append(1)
        raise OSError

    with pytest.raises(OSError):
        sink.write_with_retries(broken, [1], lambda _: None)
    assert len(calls) == 6 and [len(b) for b in sink.batches(range(60), 25)] == [25, 25, 10]


def test_stream_applies_each_file_once(spark, exports, tmp_path):
    from chronofold.streaming.apply import start

    root, (full, incremental) = exports
    target, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")
    for name, rows in (("full", 60), ("incremental", 45), ("incremental", 45)):
        start(spark, f"{root}/exports/{name}/data", target, checkpoint + name, list(KEYS), once=True).awaitTermination(120)
        assert read_current(spark, target).count() == rows


def test_command_line(spark, tmp_path, capsys):
    root = str(tmp_path / "x")
    assert cli.main(["generate", "--path", root, "--items", "10", "--updates", "3", "--deletes", "2"]) == 0
    full, incremental = capsys.readouterr().out.split()
    for path in (full, incremental):
        assert cli.main(["--table", "t", "--export", path, "--target", f"{root}/t", "--keys", "PK,SK", "--shutdown-timeout", "5m"]) == 0
    assert "total_items: 5" in capsys.readouterr().out
    assert cli.main(["verify", "--source", f"{root}/t", "--target", f"{root}/t"]) == 0


def test_report_and_generator():
    assert throughput(10, 0) == 0 and throughput(10, 2) == 5
    assert duration_text(3723.5) == "1h2m3.5s" and duration_text(0.25) == "0.25s"
    assert random_item(3, Shape()) == random_item(3, Shape()) != random_item(3, Shape(seed=1))
