"""What must not be lost: keyless lines, pointers, steps that were done, stopped runs; and the helpers around them."""

import json
import os
import shutil
import threading
import time

import pytest
from pyspark.sql import functions as F

from chronofold.operators import sink
from chronofold.operators.decode import NO_KEYS, decode_lines, with_keys
from chronofold.operators.rank import place_in_partition
from chronofold.operators.verify import canonical_number, compare_tables
from chronofold.plans import cli, progress
from chronofold.plans.config import Config
from chronofold.plans.datagen import KEYS, Shape, full_lines, lifecycle_lines, write_export
from chronofold.plans.report import file_counts, operation_counts
from chronofold.plans.restore import restore
from chronofold.sources.ledger import DONE, STAGED, MemoryLedger, ParquetLedger, totals
from chronofold.sources.manifest import load_manifest, verify_checksums


def test_lines_without_keys_are_corrupt(spark, tmp_path):
    lines = full_lines(Shape(items=5))
    keyless = json.loads(lines[0])
    del keyless["Item"]["SK"]
    path = write_export(spark, str(tmp_path), "keyless", [*lines, json.dumps(keyless)])
    result = restore(spark, Config("t", path, KEYS), str(tmp_path / "t"))
    assert (result.report.total_items, result.report.corrupt_count, result.snapshot.count()) == (5, 1, 5) and result.report.warnings
    with pytest.raises(ValueError):
        restore(spark, Config("t", path, KEYS, on_corrupt="fail"), str(tmp_path / "u"))
    found = with_keys(decode_lines(spark.createDataFrame([(json.dumps(keyless),), ('{"Keys":{"PK":{"S":"1"}},"OldImage":{"PK":{"S":"1"},"SK":{"S":"2"}}}',)], "line string")), list(KEYS)).collect()
    assert [(r.op, r.is_corrupt, r.reason) for r in found] == [(None, True, NO_KEYS)] * 2


def test_a_lost_pointer_is_no_empty_table(spark, tmp_path):
    target = str(tmp_path / "table")
    full = write_export(spark, str(tmp_path), "full", full_lines(Shape()))
    incremental = write_export(spark, str(tmp_path), "inc", lifecycle_lines(Shape()), "INCREMENTAL")
    with pytest.raises(sink.NoTable):
        sink.read_current(spark, target)
    restore(spark, Config("t", full, KEYS), target)
    shutil.rmtree(f"{target}/pointers")
    with pytest.raises(sink.LostPointer):
        restore(spark, Config("t", incremental, KEYS, "INCREMENTAL"), target)
    assert len([n for n in os.listdir(target) if n.startswith("v-")]) == 1


def test_versions_and_pointers(spark, tmp_path):
    path = str(tmp_path / "table")
    table = lambda k: spark.createDataFrame([(k,)], "k int")
    names = [sink.swap_in(table(k), path, keep=2) for k in range(4)]
    assert sink.read_current(spark, path).first().k == 3 and sink.current_version(spark, path) == (4, names[-1])
    assert sorted(n for n in os.listdir(path) if n.startswith("v-")) == sorted(names[-2:])
    with pytest.raises(FileExistsError):
        sink.put_new(spark, f"{path}/pointers/p-{4:012d}", b"other")
    # a writer that died after its pointer: the next reader finishes what it began
    os.rename(f"{path}/{names[-1]}", f"{path}/_{names[-1]}")
    assert sink.read_current(spark, path).first().k == 3
    # one that died before its pointer leaves nothing that counts
    table(9).write.parquet(f"{path}/_v-000000000000009-00000000")
    assert sink.read_current(spark, path).first().k == 3


def test_a_run_that_dies_goes_on_with_the_files_that_are_left(spark, tmp_path):
    root = str(tmp_path)
    full = write_export(spark, root, "full", full_lines(Shape()), files=5)
    config = Config("t", full, KEYS, files_per_step=2, tries=1, keep_versions=2)
    ledger = ParquetLedger(spark, f"{root}/ledger")

    class Dying(ParquetLedger):
        def append(self, rows):
            if self.read().count() >= 2:
                raise OSError("gone")
            super().append(rows)

    with pytest.raises(OSError):
        restore(spark, config, f"{root}/t", Dying(spark, f"{root}/ledger"))
    assert {r.state for r in ledger.read().collect()} == {STAGED} and ledger.read().count() == 2
    staged = [r.file for r in ledger.read().collect()]
    for f in staged:  # what is staged isn't read again
        os.remove(f"{root}/{f}")
    said = []
    result = restore(spark, config, f"{root}/t", ledger, said.append)
    assert result.report.total_items == 100 and result.snapshot.count() == 100 and not result.report.warnings
    assert totals(ledger.read(), load_manifest(spark, full).export_id).first().asDict() == {"files": 5, "items": 100, "corrupt": 0}
    assert ledger.read().where(F.col("state") == DONE).count() == 5 and not os.path.exists(f"{root}/t/_staging/x")
    again = restore(spark, config, f"{root}/t", ledger)
    assert again.report.total_items == 0 and again.snapshot.count() == 100


def test_steps_keep_the_order_of_the_whole_export(spark, tmp_path):
    """A later file holds earlier writes of the same key."""
    root = str(tmp_path)
    image = lambda v: {"PK": {"S": "a"}, "SK": {"S": "b"}, "v": {"N": str(v)}}
    line = lambda v, micros: json.dumps({"Metadata": {"WriteTimestampMicros": {"N": str(micros)}}, "Keys": {k: image(v)[k] for k in KEYS}, "NewImage": image(v)})
    path = write_export(spark, root, "late", [line(k, 100 - k) for k in range(8)], "INCREMENTAL", files=4)
    results = [restore(spark, Config("t", path, KEYS, "INCREMENTAL", files_per_step=n), f"{root}/t{n}", MemoryLedger(spark)).snapshot.first().item["v"] for n in (0, 1, 3)]
    assert results == ['{"N":"0"}'] * 3


def test_batches_are_counted_by_file(spark):
    rows = [("a", "PUT")] * 10 + [("a", "DELETE")] * 10 + [("b", "UPDATE")] * 26 + [("b", None)] * 30 + [("c", None)]
    got = file_counts(operation_counts(spark.createDataFrame(rows, "file string, op string")), 25).collect()
    assert sorted(map(tuple, got)) == [("a", 20, 0, 1), ("b", 26, 30, 2), ("c", 0, 1, 0)]


def test_errors_are_tried_again_and_counted():
    errors, waits, left = [], [], [OSError("a"), ValueError("b")]

    def work():
        if left:
            raise left.pop(0)
        return "done"

    assert progress.tried(work, 3, errors.append, waits.append) == "done" and len(errors) == 2 and waits == [2.0, 4.0]
    with pytest.raises(ZeroDivisionError):
        progress.tried(lambda: 1 / 0, 2, errors.append, waits.append)
    assert len(errors) == 4


def test_progress_and_stopping(spark):
    said, seen = [], progress.Totals(7, 1)
    with progress.shown_progress(spark, seen, said.append, every=0.05):
        spark.range(4).repartition(4).foreach(lambda _: time.sleep(1.0))
    assert any(line.startswith("Progress: 7 items decoded in 1 batches (") and "(0 active" not in line for line in said)
    ended = []
    began = time.time()
    with pytest.raises(progress.Cancelled):
        with progress.stoppable(spark, 60, ended.append) as stop:
            threading.Timer(1.0, stop).start()
            spark.range(8).repartition(8).foreach(lambda _: time.sleep(30))
    assert time.time() - began < 25 and not ended
    assert spark.range(3).count() == 3  # later jobs aren't touched
    spark.sparkContext.setJobGroup("mine", "the caller's")
    with progress.stoppable(spark, 60):
        assert spark.sparkContext.getLocalProperty("spark.jobGroup.id").startswith("restore-")
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") == "mine"
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    with progress.stoppable(spark, 0.2, ended.append) as stop:
        stop()
        time.sleep(0.8)
    assert ended == [130]


def test_checksums_by_full_path(spark, tmp_path):
    root = str(tmp_path)
    manifest = load_manifest(spark, write_export(spark, root, "x", full_lines(Shape(items=12)), files=3))
    keys = [f["dataFileS3Key"] for f in manifest.files]
    shutil.copytree(f"{root}/exports/x/data", f"{root}/exports/x/data/exports/x/data")  # the same names, further down
    name = keys[0].rpartition("/")[2]
    os.remove(f"{root}/exports/x/data/.{name}.crc")  # else the file system itself reports the damage
    with open(f"{root}/{keys[0]}", "ab") as f:
        f.write(b"x")
    os.remove(f"{root}/{keys[1]}")
    assert {r.dataFileS3Key: r.status for r in verify_checksums(spark, manifest).collect()} == dict(zip(keys, ["mismatch", "missing", "ok"], strict=True))


def test_differences_at_any_depth(spark):
    def nested(depth, inner):
        return nested(depth - 1, {"M": {"k": {"L": [inner]}}}) if depth else inner

    values = [{"SS": ["b", "a"]}, {"NS": ["1.50", "10"]}, {"N": "1"}, {"N": "0.1e2"}, {"N": "12345678901234567890123456789012345678"}, {"S": "1.0"}]
    same = [{"SS": ["a", "b"]}, {"NS": ["10.0", "1.5"]}, {"N": "1.0"}, {"N": "10"}, {"N": "12345678901234567890123456789012345678.00"}, {"S": "1.0"}]
    other = [{"SS": ["a", "c"]}, {"NS": ["10", "1.6"]}, {"N": "2"}, {"N": "1"}, {"N": "12345678901234567890123456789012345679"}, {"S": "1"}]
    table = lambda rows: spark.createDataFrame([(f"{d}.{k}", {"x": json.dumps(nested(d, v)), "y": None}) for d in (0, 1, 7) for k, v in enumerate(rows)], "key string, item map<string,string>")
    assert compare_tables(table(values), table(same)).count() == 0
    assert compare_tables(table(values), table(other)).where("status = 'changed'").count() == 3 * len(values)
    assert canonical_number("-0") == canonical_number("0.00") == "0" and canonical_number("x") == "x"


def test_places_in_partitions(spark):
    rows = [(k % 3 if k % 7 else None, (k * 37) % 50, k) for k in range(500)]
    df = spark.createDataFrame(rows, "p int, s int, t int")
    for down in (False, True):
        expected = set()
        for p in {r[0] for r in rows}:
            own = sorted((r for r in rows if r[0] == p), key=lambda r: (r[1], r[2]), reverse=down)
            expected |= {(*r, n) for n, r in enumerate(own, 1)}
        assert {tuple(r) for r in place_in_partition(df, "p", "s", "t", cuts=8, descending=down).collect()} == expected
    assert place_in_partition(df.where("false"), "p", "s", "t").count() == 0


def test_command_line_checks_remote_exports_and_runs_the_lifecycle(spark, tmp_path, capsys):
    base = ["restore", "--table", "t", "--export", "s3://b/k", "--target", str(tmp_path / "t"), "--keys", "PK,SK"]
    assert cli.main(base) == 2 and "region is required" in capsys.readouterr().err
    assert cli.main([*base, "--region", "r", "--report", "x"]) == 2 and "report URI" in capsys.readouterr().err
    assert cli.main(["lifecycle", "--path", str(tmp_path / "life"), "--items", "20", "--updates", "15", "--deletes", "10"]) == 0
    out = capsys.readouterr().out
    assert out.count("ok  ") == 9 and "expected 10, found 10" in out


def test_lines_are_parsed_once(spark):
    from chronofold.operators.apply import apply_operations

    lines = spark.createDataFrame([('{"Item":{"pk":{"S":"1"}}}', 1)], "line string, seq int")
    plan = apply_operations(with_keys(decode_lines(lines), ["pk"]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and len(plan) < 60_000
