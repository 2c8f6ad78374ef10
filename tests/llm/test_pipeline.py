"""Each stage of the corpus pipeline against brute force on its own input."""

import os

import pytest

from coverloom.llm import sentence_pieces
from tests.llm import brute

pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture()
def folder(spark, docs, prose, tmp_path):
    wide = docs.selectExpr("*", "'v' as score", "doc_id as n_bytes", "7 as _id", "8 as _doc", "9 as e", "10 as window")
    wide.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, prose(60, 777)), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages(spark, folder, tmp_path):
    d = spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["language ID", "n-gram Jaccard join", "suffix-array dedup", "benchmark decontamination", "sentence pieces"]
    for i, (name, stage) in enumerate(pipeline.STAGES):
        before = texts(d)
        out = stage(spark, d, folder)
        out.write.parquet(f"{tmp_path}/out{i}")
        out = spark.read.parquet(f"{tmp_path}/out{i}")
        if i == 4:
            assert set(out.columns) == {"doc_id", "n_pieces", "ids", "lossless"} and out.where("not lossless").isEmpty()
            assert texts(sentence_pieces.decode(out)) == before
            break
        assert out.columns == d.columns and out.where("score <> 'v' or n_bytes <> doc_id or _id <> 7 or _doc <> 8 or e <> 9 or window <> 10").isEmpty()
        after = texts(out)
        if i == 0:
            assert set(before) - set(after) >= {400, 401, 402, 410} and all(before[k] == t for k, t in after.items()) and len(after) > 0.9 * len(before)
            assert out.where("lang is null").isEmpty()
        elif i == 1:
            assert after == {k: t for k, t in before.items() if brute.components(before.items())[k][1] == k}
        elif i == 2:
            want = brute.repeats(before.items())
            assert set(after) == {k for k, (n, gone, *_) in want.items() if not n or gone < n}
            assert all(len(t.encode()) >= want[k][0] - want[k][1] for k, t in after.items())
            assert all(after[k] == before[k] for k, w in want.items() if not w[1])
        elif i == 3:
            bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
            assert after == {k: t for k, t in before.items() if not brute.contamination([(k, t)], bench)[k][1]}
        d = out


def test_texts_of_several_languages_stay(spark, prose):
    turned = str.maketrans("abcdefghijklmnopqrstuvwxyz", "nopqrstuvwxyzabcdefghijklm")
    kinds = [str, lambda t: "".join(reversed(t)), lambda t: t.translate(turned)]
    rows = [(100 * c + i, f(prose(30, 100 * c + i)), "xyz"[c]) for c, f in enumerate(kinds) for i in range(30)]
    rows += [(900, "\n".join(f(prose(20, 990 + c)) for c, f in enumerate(kinds)), None), (901, "- 7", None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    model = pipeline.language_id.train(d)
    mixed = pipeline.language_id.identify(d.where("doc_id = 900"), model).first()
    assert mixed["score"] < pipeline.MIN_SCORE < mixed["confidence"]
    kept = {r["doc_id"] for r in pipeline.identify_language(spark, d, "").collect()}
    assert 900 in kept and 901 not in kept


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="the driver's tables aren't here")
def test_run(spark):
    out = pipeline.run(spark, "/root/testdata/sf0.001")
    n = out.count()
    assert 100 < n <= 200 and out.where("not lossless").isEmpty()


def test_empty_corpus(spark, folder, tmp_path):
    d = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for i, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, d, folder).write.parquet(f"{tmp_path}/e{i}")
        d = spark.read.parquet(f"{tmp_path}/e{i}") if i < 4 else d
        assert d.isEmpty()


def test_stages_with_null_and_repeated_ids_and_a_long_text(spark, folder, prose, tmp_path):
    """Nulls in every column, rows that share an id, a text of a megabyte: clean rows stay, all of them."""
    d = spark.read.parquet(f"{folder}/documents.parquet")
    more = [(None, prose(40, 6001), "en"), (None, prose(40, 6002), None), (7000, prose(40, 6003), "de"), (7000, prose(40, 6004), "de"), (7001, prose(200_000, 6005), "en"), (7002, "x" * 300_000 + " " + prose(30, 6006), "en"), (None, None, None)]
    extra = spark.createDataFrame(more, "doc_id long, text string, lang string")
    d = d.unionByName(extra, allowMissingColumns=True)
    clean = sorted(t for _, t, _ in more[:4])
    for i, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, d, folder).write.parquet(f"{tmp_path}/n{i}")
        out = spark.read.parquet(f"{tmp_path}/n{i}")
        if i == 4:
            assert out.where("not lossless").isEmpty() and out.count() == d.count()
        else:
            got = out.where("doc_id is null or doc_id = 7000").collect()
            assert sorted(r["text"] for r in got) == clean
            assert out.where("doc_id in (7001, 7002)").count() == 2
        d = out


def test_a_stage_deletes_its_predecessor_s_tables_alone(spark, folder):
    d = spark.read.parquet(f"{folder}/documents.parquet")
    other = pipeline.ngram_join.join(d)
    pipeline.one_of_each_group(spark, d, folder)
    kept = pipeline.cut_repeats(spark, d, folder)
    assert other.count() == d.count() and 0 < kept.count() <= d.count()


def test_scratch_folders_need_a_shared_place_on_a_cluster(spark):
    from coverloom.llm import util

    class Session:
        conf, sparkContext = type("C", (), {"get": lambda *_: None}), type("S", (), {"master": "spark://there:7077"})

    with pytest.raises(ValueError):
        util.shared_dir(Session)
    with util.collecting() as made:
        t = util.materialize(spark.range(3), "x")
    assert len(made) == 1 and t.count() == 3
    util.delete(spark, made)
    with pytest.raises(Exception, match="exist"):
        spark.read.parquet(f"{made[0]}/x")
