"""Merkle manifest, line dedup and collocations against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from coverloom.llm import collocations, line_dedup, merkle, queries
from tests.llm import brute


def leaf(*fields):
    return brute.sha(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields])


def manifest(rows, fanout=2):
    """Of rows (doc_id, lang, text): sorted (doc_id, leaf, subroot, root, proof)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(((r[0] is not None, r[0] or 0), leaf(*r), r[0]))
    groups = {g: sorted(own) for g, own in groups.items()}
    root, subs = brute.merkle({g: [x[1] for x in own] for g, own in groups.items()}, fanout)
    return sorted(repr((i, h, subs[g][0], root, proof)) for g, own in groups.items() for (_, h, i), proof in zip(own, subs[g][1]))


def proofs(df, **more):
    out = merkle.prove(merkle.build(df, ["doc_id", "lang", "text"], "lang", "doc_id", keep={"doc_id": F.col("doc_id")}, **more))
    return sorted(repr((r["doc_id"], r["leaf"], r["subroot"], r["root"], [(s["left"], s["right"]) for s in r["proof"]])) for r in out.collect()), out


@pytest.mark.parametrize("fanout, stride", [(2, 8), (2, 1), (3, 2), (5, 1)])
def test_manifest(spark, corpus, fanout, stride):
    """Blocks of few levels, so that trees have several block levels."""
    rows = [(i, ["en", "de", None, "en", "en"][x % 5], t) for x, (i, t) in enumerate(corpus)]
    rows += [(7, "one", "alone"), (None, "de", "no id"), (None, "de", None), (3, "de", "tie"), (3, "de", "tie"), (3, "de", "other")]
    got, out = proofs(spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(5), fanout=fanout, stride=stride)
    assert got == manifest(rows, fanout)
    assert out.where(merkle.fold(F.col("leaf"), F.col("proof")) != F.col("root")).isEmpty()


@pytest.mark.parametrize("rows", [[(1, "a", "x")], [(1, None, None)], [(1, "a", "x"), (2, "b", "")], [(i, "a", "x") for i in range(5)]])
def test_small_manifests(spark, rows):
    d = spark.createDataFrame([(*r, "v", "w", 1) for r in rows], "doc_id long, lang string, text string, tree string, hash string, pos int")
    assert proofs(d, stride=2)[0] == manifest(rows)
    assert proofs(d.where("false"))[0] == []


def test_manifest_query(spark, tmp_path, corpus):
    """Tampered rows are told apart; a null isn't tampered with."""
    rows = [(i, t, ["en", None][x % 2], [None, "s"][x % 3 == 0], None if x % 4 == 0 else x) for x, (i, t) in enumerate(corpus)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    import zlib

    got = {r["doc_id"]: r for r in queries.op11_merkle_manifest(spark, str(tmp_path)).collect()}
    for i, t, lang, source, n in rows:
        r, changed = got[i], zlib.crc32(str(i).encode()) % 7 == 0 and n is not None
        assert r["leaf"] == leaf(i, source, lang, n, t) and r["verified"] == (not changed) and (r["folded_root"] == r["root"]) == (not changed)
    assert not all(r["verified"] for r in got.values())


def left(state, docs):
    return Counter((r["doc_id"], r["n_lines"], r["n_dropped"], bytes(r["kept"])) for r in line_dedup.dedup(state, docs).collect())


@pytest.fixture(scope="module")
def pages(spark, prose):
    """Texts of lines that many share, in other cases and with white space round them."""
    r, common = random.Random(4), [prose(6, i) for i in range(12)] + ["é" * 20, "é" * 19, "Zwanzig \tZeichen lang", "x" * 20, "X" * 20]
    rows = []
    for i in range(60):
        own = [r.choice([" ", "", "\t\r"]) + (c.upper() if r.random() < 0.2 and c.isascii() else c) + r.choice(["", " \x0b"]) for c in r.choices(common, k=r.randrange(6))]
        rows.append((i, "\n".join(r.sample(own + [prose(5, 100 + i), "", "short"], len(own) + 3))))
    rows += [(70, None), (71, ""), (72, "\n\n"), (None, common[0]), (5, common[1]), (5, common[1] + "\n" + common[1]), (73, prose(30_000, 3)), (74, f"{common[2]}\n" * 3000)]
    names = "k1, k2, n, last, old, shard, slots, gone, kept, _doc, _maybe, _keys"
    full = [(*x, *["v"] * 12) for x in rows]
    return rows, spark.createDataFrame(full, "doc_id long, text string, " + ", ".join(f"`{c.strip()}` string" for c in names.split(","))).repartition(4).cache()


@pytest.mark.parametrize("hot, room", [(50_000, 32 << 20), (10, 0)])
def test_line_dedup(pages, monkeypatch, hot, room):
    """With filters and without, keys joined by broadcast or shuffled."""
    rows, d = pages
    monkeypatch.setattr(line_dedup, "HOT_KEYS", hot)
    monkeypatch.setattr(line_dedup, "FILTER_BYTES", room)
    got = left(line_dedup.insert(None, d), d)
    assert got == Counter(brute.lines(rows)) and sum(x[2] > 0 for x in got) > 30


def test_documents_come_and_go(pages, monkeypatch):
    """What is inserted and deleted again leaves no trace; in between counts, filters and texts follow what is there."""
    rows, d = pages
    a, b = d.where("doc_id % 2 = 0 or doc_id is null"), d.where("doc_id % 2 = 1")
    few = [x for x in rows if x[0] is None or x[0] % 2 == 0]
    one = line_dedup.insert(None, a)
    both = line_dedup.insert(one, b)
    assert left(both, d) == Counter(brute.lines(rows))
    back = line_dedup.delete(both, b)
    counts = lambda s: sorted(map(tuple, s.counts.select("k1", "k2", "n", "last").collect()), key=repr)
    assert counts(back) == counts(one) and back.common == one.common < both.common
    assert left(back, a) == Counter(brute.lines(few))
    held = line_dedup.Filters(back.shards, back.filters.collect())
    keys = np.array([(r["k1"], r["k2"]) for r in one.counts.where("n >= 3").collect()], np.int64)
    assert held.may_hold(keys[:, 0].copy(), keys[:, 1].copy()).all() and int((held.slots > 0).sum()) + len(held.stash) == one.common
    gone = line_dedup.delete(back, a.select("doc_id"))
    assert gone.common == 0 and gone.counts.isEmpty() and gone.holders.isEmpty()
    again = line_dedup.insert(gone, d)
    assert left(again, d) == Counter(brute.lines(rows))


def test_more_shards_when_filters_fill_up(pages, monkeypatch):
    rows, d = pages
    monkeypatch.setattr(line_dedup, "PLANNED", 3)
    monkeypatch.setattr(line_dedup, "FULL", 5)
    state = line_dedup.insert(line_dedup.insert(None, d.where("doc_id < 6")), d.where("doc_id >= 6 or doc_id is null"))
    assert state.shards >= 4 and left(state, d) == Counter(brute.lines(rows))


def test_line_dedup_of_nothing(pages):
    _, d = pages
    none = line_dedup.insert(None, d.where("false"))
    assert line_dedup.dedup(none, d.where("false")).isEmpty() and none.common == 0
    assert line_dedup.dedup(none, d, keep=("shard",)).where("n_dropped > 0 or shard <> 'v'").isEmpty()


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(-(1 << 63), (1 << 63) - 1), st.integers(0, 3)), min_size=1, max_size=200, unique=True), st.data())
def test_cuckoo_filter(keys, data):
    """No key is missed, many of one fingerprint are stashed, and deleting some leaves the others."""
    k1, k2 = (np.array(x, np.int64) for x in zip(*keys))
    one = line_dedup.Cuckoo()
    one.insert(np.concatenate((k1, np.full(20, 5))), np.concatenate((k2, np.arange(20) << 16)))
    assert len(one.stash) >= 12
    gone = np.array(data.draw(st.lists(st.booleans(), min_size=len(keys), max_size=len(keys))))
    one.delete(k1[gone], k2[gone])
    slots, stash = one.blobs()
    held = line_dedup.Filters(1, [{"shard": 0, "slots": slots, "stash": stash}])
    assert held.may_hold(k1[~gone], k2[~gone]).all() and held.may_hold(np.full(20, 5), np.arange(20) << 16).all()
    assert int((one.slots > 0).sum()) + len(one.stash) == int((~gone).sum()) + 20


def mined(df, **more):
    return sorted((r["grp"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in collocations.mine(df, **more).collect())


@pytest.fixture(scope="module")
def talk(spark, prose):
    r, rows = random.Random(2), []
    stock = ["New York City", "new york", "to be or not to be", "a a a a a a", "ça et là", "one,two", "x\ty"]
    for i in range(120):
        words = prose(r.randrange(40), i % 40).split()
        for _ in range(r.randrange(5)):
            words.insert(r.randrange(len(words) + 1), r.choice(stock) + r.choice(["", ".", "!", "\n", "\x0b"]))
        rows.append((["en", "de", None, "en", "und"][i % 5], " ".join(words)))
    rows += [("en", None), ("en", ""), (None, " \n\t."), ("fr", "only words once"), ("en", "w" * 100_000), ("en", prose(20_000, 9))]
    full = [(*x, *["v"] * 6) for x in rows]
    return rows, spark.createDataFrame(full, "lang string, text string, grp string, word string, n string, ids string, key string, slot string").repartition(4).cache()


@pytest.mark.parametrize("count, top", [(3, 2000), (12, 7)])
def test_collocations(talk, count, top):
    rows, d = talk
    got = mined(d, min_count=count, top=top)
    assert got == brute.collocations(rows, count, top=top) and max(len(x[2].split()) for x in got) == 5


def test_collocations_in_slices_and_small_steps(talk, monkeypatch):
    """Words and keys in many slices, small blocks and steps, a tree of several levels."""
    rows, d = talk
    for name, size in (("WORDS_SLICE", 60), ("KEYS_SLICE", 500), ("STEP", 300), ("FLUSH_WORDS", 50), ("FLUSH_KEYS", 100), ("BLOCK", 64), ("ARITY", 2), ("BROADCAST_ROWS", 5)):
        monkeypatch.setattr(collocations, name, size)
    assert mined(d, min_count=6) == brute.collocations(rows, 6)


def test_collocations_of_nothing(talk):
    _, d = talk
    assert mined(d.where("false")) == [] and mined(d, min_count=10**6) == [] and mined(d, min_count=2, longest=1) == []


def test_scores_beyond_64_bits(spark):
    """Counts of billions: the levels' numbers are put in by hand."""
    a, n, first, rest = 9_000_000_000_123, 10**14 + 7, 9_000_000_000_124, 9_100_000_000_000
    q = "cast(1000 * a as decimal(19, 0)) * cast(n as decimal(18, 0)) div (cast(l as decimal(19, 0)) * cast(r as decimal(18, 0)))"
    got = spark.sql(f"select {q} as s from values ({a}L, {n}L, {first}L, {rest}L) as t(a, n, l, r)").first()[0]
    assert got == 1000 * a * n // (first * rest)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(-(1 << 63), (1 << 63) - 1), unique=True, max_size=3000), st.lists(st.integers(-(1 << 63), (1 << 63) - 1), max_size=200))
def test_perfect_hash(keys, others):
    keys = np.array(keys, np.int64)
    table = collocations.PerfectHash(keys)
    slots = table.slots(keys)
    assert sorted(slots.tolist()) == list(range(len(keys))) and (table.keys[slots] == keys).all()
    own = set(keys.tolist())
    other = np.array([x for x in others if x not in own], np.int64)
    assert (table.slots(other) == -1).all()


def test_digest_of_the_line_query(spark, tmp_path, pages):
    rows, d = pages
    d.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in queries.op12_line_dedup(spark, str(tmp_path)).collect())
    assert got == Counter((i, n, x, hashlib.sha256(t).hexdigest()) for i, n, x, t in brute.lines(rows))
