"""The pipeline's rows against the stages' brute-force versions, and its queries' names."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

LOWER = {i: i + 32 for i in range(65, 91)}


def test_pipeline_stage_by_stage(spark, sf_dir):
    import corpus_pipeline as p
    from chronofold import ship

    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [name for name, _ in p.STAGES] == ["quality_classifier", "exact_dedup", "ngram_jaccard_join", "benchmark_decontamination", "bpe_encoding"]
    kept = {}
    for name, stage in p.STAGES[:4]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    best = {}
    for i, t in kept["quality_classifier"].items():
        key = t.translate(LOWER)
        best[key] = max(best.get(key, -1), i)
    assert set(kept["exact_dedup"]) == set(best.values())
    words = re.compile(r"[^\x20\x09-\x0d]+")
    sets = {}
    for i, t in kept["exact_dedup"].items():
        w = words.findall(t.translate(LOWER))
        sets[i] = {tuple(w[a : a + 5]) for a in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    label = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            both = len(sets[a] & sets[b]) if a < b else 0
            if both and 10 * both >= 8 * len(sets[a] | sets[b]):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {i: new if x == old else x for i, x in label.items()}
    assert set(kept["ngram_jaccard_join"]) == {i for i, x in label.items() if i == x}
    windows = set()
    alnum = re.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        w = alnum.findall((r.text or "").translate(LOWER))
        windows |= {tuple(w[a : a + min(10, len(w))]) for a in range(len(w) - min(10, len(w)) + 1) if w}
    sizes = {len(x) for x in windows}

    def hit(text):
        w = alnum.findall(text.translate(LOWER))
        return any(tuple(w[a : a + n]) in windows for n in sizes for a in range(len(w) - n + 1))

    assert set(kept["benchmark_decontamination"]) == {i for i, t in kept["ngram_jaccard_join"].items() if not hit(t)}
    last = p.run(spark, sf_dir).collect()
    assert {r.doc_id for r in last} == set(kept["benchmark_decontamination"])
    for r in last:
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest() and len(r.ids) == r.n_tokens
        assert r.decoded_sha256 == hashlib.sha256(kept["benchmark_decontamination"][r.doc_id].encode()).hexdigest()


@pytest.fixture(scope="module")
def odd_tables(spark, tmp_path_factory):
    """Null texts and ids, repeated rows and ids, a long text, extra columns with names that stages use."""
    folder = str(tmp_path_factory.mktemp("odd"))
    good = [" ".join(f"word{(k * j) % 97}" for j in range(40)) for k in range(1, 30)]
    rows = [(k, t, "en", "s", len(t), "x", 1) for k, t in enumerate(good)]
    rows += [(3, good[3], "en", "s", 1, "x", 1), (4, good[5] + " other", "en", "s", 1, None, 1), (50, good[7].upper(), "en", None, 1, "x", 1), (51, good[8] + " tail", None, "s", 1, "x", 1), (52, good[9] + " " + "l" * 50000, "en", "s", 1, "x", 1)]
    rows += [(60, None, None, None, None, None, None), (61, None, None, None, None, None, None), (None, "no id here at all", "en", "s", 1, "x", 1), (None, "NO ID here at all", "en", "s", 1, "x", 1), (62, "", "en", "s", 0, "x", 1)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, ids string, bucket int").write.parquet(f"{folder}/documents.parquet")
    labels = [(k, int(k % 4 > 0), 0) for k in range(29)] + [(None, 1, 1), (3, 0, 0)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, " ".join(good[11].split()[5:25])), (2, None), (None, "nothing of this kind")], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows


def test_pipeline_over_odd_rows(spark, odd_tables, monkeypatch):
    import corpus_pipeline as p
    from chronofold import ship

    ship(spark)
    folder, rows = odd_tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in p.STAGES[:4]:
        assert stage(spark, docs, folder).columns == docs.columns, name
    names = [n for n, _ in p.STAGES]
    kept = p.STAGES[names.index("exact_dedup")][1](spark, docs, folder).collect()
    best = {}
    for i, t, *_ in rows:
        key = (t or "").translate(LOWER)
        best[key] = max(best.get(key, -1), -1 if i is None else i)
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept) == sorted(best.values())
    near = p.STAGES[names.index("ngram_jaccard_join")][1](spark, docs, folder).collect()
    assert {r.doc_id for r in near} >= {None, 0, 3, 60, 61, 62} and 51 not in {r.doc_id for r in near} and sum(r.doc_id == 3 for r in near) == 2
    clean = p.STAGES[names.index("benchmark_decontamination")][1](spark, docs, folder).collect()
    assert len(clean) == len(rows) - 1 and 11 not in {r.doc_id for r in clean}
    # without the classifier's choice the rest of the pipeline keeps what it must
    monkeypatch.setattr(p, "STAGES", p.STAGES[1:])
    last = p.run(spark, folder).collect()
    ids = {r.doc_id for r in last}
    assert {0, 1, 2, 3, 10, 62} <= ids and not ids & {11, 60, 61, 7} and next(r for r in last if r.doc_id == 62).n_tokens == 0
    assert all(len(r.ids) == r.n_tokens for r in last)


def test_pipeline_over_empty_tables(spark, odd_tables, tmp_path):
    import corpus_pipeline as p

    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{odd_tables[0]}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert p.run(spark, str(tmp_path)).count() == 0
    spark.read.parquet(f"{odd_tables[0]}/documents.parquet").where("doc_id < 10").write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert p.run(spark, str(tmp_path)).count() > 5  # without labels nothing is rejected


def test_poor_documents_go_and_good_ones_stay(spark, sf_dir):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {r.doc_id for r in p.STAGES[0][1](spark, docs, sf_dir).select("doc_id").collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").groupBy("quality").agg(F.collect_list("doc_id").alias("ids")).collect()
    share = {r.quality: sum(i in kept for i in r.ids) / len(r.ids) for r in labels}
    assert share[1] > 0.97 and share[0] < 0.2


def test_registered_queries():
    import __spark_entry__ as e

    names = set(e.queries())
    assert {n.split("_")[0] for n in names if re.match(r"op\d+_", n)} == {f"op{k}" for k in range(1, 11)} and "pipeline" in names
