"""Quality rules, URL filters, decontamination and sharding."""

import re
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from coverloom.llm import decontamination, quality_rules, sharding, url_filter
from tests.llm import brute


def test_quality_counts(spark, docs, corpus):
    got = {r["doc_id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in quality_rules.judge(docs).collect()}
    assert got == {i: brute.quality(t) for i, t in corpus}


def test_quality_verdicts(spark, prose):
    clean, again = prose(80, 3), "one two three four five six seven " * 8
    rows = [(1, clean), (2, " ".join(w + "###" for w in clean.split())), (3, again), (4, "too few words"), (5, None), (6, "\n".join([prose(6, 9)] * 9 + [prose(9, 8)])), (7, " ".join(w.upper() + "!!" for w in clean.split())), (8, "zzz " + " ".join(f"w{i}" for i in range(60)))]
    q = {r["doc_id"]: r for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i for i, r in q.items() if r["kept"]} == {1}
    assert {i for i, r in q.items() if r["base_failed"]} >= {3, 4, 5} and "symbols_per_word" in q[2]["failed_rules"] and "shouts_per_word" in q[7]["failed_rules"] and q[8]["failed_rules"] == ["stop_word_ratio"]


def test_quality_table_is_a_parameter(spark):
    d = spark.createDataFrame([(1, "a b c d e f g h i j k")], "doc_id long, text string")
    assert quality_rules.judge(d, rules=()).first()["kept"] and not quality_rules.judge(d, rules=(quality_rules.Rule("mean_word_chars", 2),)).first()["kept"]


def test_quality_runs_without_exchange_or_python(spark, docs):
    plan = quality_rules.judge(docs.coalesce(1))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def ref_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), re.match(r"[^?#]*", rest[len(host) :]).group()


URLS = ["http://WWW.Example.com/en/a?x=1", "https://example.com/en/", "http://example.com/fr", "x://a.net/es/1#t", "http://net/fr/", "http://anet/fr/", "no url", None, "", "http://É.org/Ä?b=2&a=1&utm_x=3", "http://m.site.org:80/a/index.html", "http://site.org/a/", "http://com", "http://com/", "a://b://c/d", "http://example.com/en/http://x.net/es/"]


def test_hosts_paths_and_rules(spark):
    d = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    got = {r["page_id"]: r for r in url_filter.judge(d, d.where("false")).collect()}
    assert {i: (r["host"], r["path"]) for i, r in got.items()} == {i: ref_url(u) for i, u in enumerate(URLS)}
    assert [got[i]["rule"] for i in (0, 1, 2, 3, 4, 5, 6, 12, 13)] == ["www.example.com/en/", "example.com/en/", "com/", "net/es/", "net/fr/", None, None, None, "com/"]
    assert [got[i]["verdict"] for i in (0, 1, 3, 7)] == ["allow", "block", "block", "allow"]


@pytest.mark.parametrize("blocks", [1, 4, 1 << 17])
def test_listed_urls_have_no_false_verdicts(spark, blocks):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.concat(F.lit("u"), (F.col("id") % 700).cast("string")).alias("canon"))
    listing = spark.range(200).select(F.concat(F.lit("u"), (F.col("id") * 3).cast("string")).alias("canon")).union(spark.sql("select cast(null as string)"))
    got = url_filter.listed(pages, listing, max_blocks=blocks)
    assert got.count() == 3000 and got.where("listed <> (cast(substring(canon, 2, 9) as int) % 3 = 0 and cast(substring(canon, 2, 9) as int) < 600)").isEmpty()


def test_canonical_urls(spark):
    d = spark.createDataFrame([(u,) for u in ("http://www.a.org/x/?b=2&a=1#t", "https://A.org:443/x?a=1&utm_source=q&b=2", "a.org", None)], "u string")
    assert [r[0] for r in d.select(url_filter.canonical(F.col("u"))).collect()] == ["a.org/x?a=1&b=2"] * 2 + [None, None]


def bench(spark, prose):
    rows = [(1, prose(60, 777)), (2, prose(60, 777)[20:90].upper()), (3, "It is!"), (4, None), (5, "..."), (6, prose(12, 31337))]
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, doc_id string"), rows


def test_decontamination(spark, docs, corpus, prose):
    b, items = bench(spark, prose)
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in decontamination.decontaminate(docs, b, keep=("lang",)).collect()}
    want = brute.contamination(corpus, items)
    assert got == want and sum(h > 0 for _, h, _ in want.values()) >= 12
    assert {r["doc_id"]: r["contaminated"] for r in decontamination.decontaminate(docs, b, limit=0, lists=3).collect()} == {i: h > 0 for i, (_, h, _) in want.items()}


def test_decontamination_of_rows_that_share_ids(spark, prose):
    d = spark.createDataFrame([(1, prose(60, 777)), (1, "other words only here"), (None, prose(60, 777)), (None, None)], "doc_id long, text string")
    b, _ = bench(spark, prose)
    assert sorted((r["doc_id"] is None, r["n_hit"]) for r in decontamination.decontaminate(d, b).collect()) == [(False, 0), (False, 60), (True, 0), (True, 60)]
    assert decontamination.decontaminate(d.where("false"), b).isEmpty() and decontamination.decontaminate(d, b.where("false")).where("contaminated").isEmpty()


def test_proximity(spark):
    d = spark.createDataFrame([(1, "a x x b a b"), (2, "b x x x a")], "doc_id long, text string")
    got = decontamination.proximity(decontamination.build_index(d), "a", "b", 2)
    assert sorted(map(tuple, got.collect())) == [(1, 4, 3), (1, 4, 5)]


def test_shards(spark, docs, tmp_path):
    store = sharding.Store(spark, f"file://{tmp_path}/s")
    assert store.version() == 0 and store.read(docs.schema).isEmpty()
    for i in range(3):
        store.append(docs, small_bytes=4000, target=200_000)
    small = store.manifest().count()
    v = store.compact(docs.schema, target=200_000)
    assert v == 4 and 0 < store.manifest().count() < small
    assert store.read(docs.schema).exceptAll(docs.union(docs).union(docs)).isEmpty() and store.read(docs.schema).count() == 3 * docs.count()
    assert store.read(docs.schema, 1).count() == docs.count()  # an old version still reads
    assert store.manifest().agg(F.sum("rows")).first()[0] == 3 * docs.count()
    assert store.compact(docs.schema, target=1) == v  # nothing to merge
    with pytest.raises(sharding.Conflict):
        store.commit(store.manifest(v).drop("version"), v - 1)  # that version is there


@pytest.mark.parametrize("plain", [True, False])
def test_one_of_two_writers_wins(spark, docs, tmp_path, plain, monkeypatch):
    store = sharding.Store(spark, f"file://{tmp_path}/s")
    store.append(docs.limit(3))
    drafts = [store.draft(store.manifest(1).drop("version").withColumn("rows", F.lit(i).cast("long")), 2) for i in range(8)]
    if plain:
        with ThreadPoolExecutor(8) as pool:
            futures = [pool.submit(store.publish, d, 2) for d in drafts]
        errors = [f.exception() for f in futures]
    else:  # the way of other file systems; on a local one it is only safe in turn
        monkeypatch.setattr(sharding.Store, "_fs", lambda self, f=sharding.Store._fs: Named(f(self)))
        errors = []
        for d in drafts:
            try:
                store.publish(d, 2)
                errors.append(None)
            except sharding.Conflict as e:
                errors.append(e)
    assert [type(e) for e in errors].count(sharding.Conflict) == 7 and errors.count(None) == 1
    assert store.version() == 2 and [r["rows"] for r in store.manifest(2).collect()][0] == errors.index(None)


class Named:
    """A file system under another name."""

    def __init__(self, fs):
        self.fs = fs

    def getUri(self):
        return self

    def getScheme(self):
        return "other"

    def __getattr__(self, name):
        return getattr(self.fs, name)


def test_a_late_writer_commits_on_top(spark, docs, tmp_path, monkeypatch):
    store = sharding.Store(spark, f"file://{tmp_path}/s")
    for _ in range(2):
        store.append(docs, small_bytes=4000, target=200_000)
    # another append is committed while an append, and then a compaction, are under way
    late = [store.version()]
    monkeypatch.setattr(store, "version", lambda: late.pop() if late else sharding.Store.version(store))
    sharding.Store(spark, store.root).append(docs)
    assert store.append(docs) == 4
    late.append(store.version())
    sharding.Store(spark, store.root).append(docs)
    assert store.compact(docs.schema, target=200_000) == 6
    assert store.read(docs.schema).count() == 5 * docs.count()
    # both merge the same shards: the second gives way
    late.append(4)
    with pytest.raises(sharding.Conflict):
        store.compact(docs.schema, target=200_000)
    assert store.read(docs.schema).count() == 5 * docs.count()


def test_shards_of_odd_rows(spark, tmp_path):
    """Names that the store uses itself, nulls in every column, repeated rows, a long text."""
    names = ["file", "tier", "Version", "run", "shard", "rows", "_metadata", "text"]
    data = [(None,) * 8, ("a",) * 8, ("a",) * 8, *[(str(i),) * 7 + ("x" * 200_000 if i == 7 else "",) for i in range(40)]]
    d = spark.createDataFrame(data, ", ".join(f"{n} string" for n in names)).repartition(4)
    store = sharding.Store(spark, f"file://{tmp_path}/o")
    for _ in range(2):
        store.append(d, small_bytes=10_000, target=1 << 20)
    assert store.compact(d.schema, target=1 << 20) == 3
    back = store.read(d.schema)
    assert back.columns == names and back.exceptAll(d.union(d)).isEmpty() and back.count() == 2 * len(data)
    assert store.read(d.schema, with_file=True).columns == [*names, "shard_"]


def test_each_run_is_one_file(spark, docs, tmp_path):
    store = sharding.Store(spark, f"file://{tmp_path}/r")
    for _ in range(4):
        store.append(docs, small_bytes=3000, target=40_000)
    plan = store.plan(store.manifest(), 40_000).collect()
    before = {r["file"] for r in store.manifest().collect()}
    store.compact(docs.schema, target=40_000)
    new = {r["file"] for r in store.manifest().collect()} - before
    assert len(new) == len({r["run"] for r in plan}) > 1


def test_shards_of_an_empty_table(spark, docs, tmp_path):
    store = sharding.Store(spark, f"file://{tmp_path}/e")
    store.append(docs.where("false"))
    store.compact(docs.schema)
    assert store.read(docs.schema).isEmpty()
