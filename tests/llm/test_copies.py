"""N-gram join and suffix-array dedup against brute force."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from coverloom.llm import components, ngram_join, suffix_dedup
from tests.llm import brute


def test_join(spark, docs, corpus):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(docs).collect()}
    want = brute.components(corpus)
    assert got == want and sum(c != i for i, (_, c) in want.items()) > 15


@pytest.mark.parametrize("light", [0, 9])
def test_join_with_any_boundary(spark, monkeypatch, prose, light):
    monkeypatch.setattr(ngram_join, "boundary", lambda *_: light)
    r, rows = random.Random(light), []
    for i in range(120):
        w = prose(r.randrange(8, 22), i % 8).split()
        if r.random() < 0.6:
            w[-1 - r.randrange(2)] = r.choice("xyz")
        rows.append((i, " ".join(w[: len(w) - r.randrange(3)])))
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.components(rows)


@pytest.mark.parametrize("hot, flush, ranges", [(-(1 << 40), 1 << 20, 1 << 20), (1 << 18, 50, 40), (30, 200, 300)])
def test_join_with_hot_cells_and_small_blobs(spark, monkeypatch, docs, corpus, hot, flush, ranges):
    """All shingles taken as hot, none, or some; many blobs and ranges."""
    monkeypatch.setattr(ngram_join, "FLUSH", flush)
    monkeypatch.setattr(ngram_join, "RANGE", ranges)
    monkeypatch.setattr(ngram_join, "SEEN", 7)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(docs, hot=hot).collect()}
    assert got == brute.components(corpus)


def test_join_of_a_large_group_of_near_copies(spark, prose):
    """A hub with 150 near copies, most of which aren't similar to each other, beside sets that share half of it."""
    r, base = random.Random(8), prose(140, 1).split()
    rows = [(77, " ".join(base))]
    for i in range(150):
        w = list(base)
        for _ in range(r.randrange(1, 6)):
            w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
        rows.append((1000 + i, " ".join(w)))
    rows += [(i, " ".join(base[: 70 + i] + prose(60, 500 + i).split())) for i in range(30)]
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    want = brute.components(rows)
    assert got == want and len({c for _, c in want.values()}) > 5


def test_join_of_long_and_repeated_rows(spark, prose):
    """Very long texts, rows that share an id with other texts, extra columns of the operator's own names."""
    long = prose(30_000, 3)
    rows = [(1, long), (2, long + " end"), (3, prose(30_000, 4)), (4, "w " * 50_000), (5, "w w w w w w"), (6, None), (7, prose(40, 9)), (8, prose(40, 9)), (8, prose(40, 9))]
    d = spark.createDataFrame([(*r, "k", 1, 2, 3) for r in rows], "doc_id long, text string, e string, s1 int, size int, rep int")
    got = sorted((x["doc_id"], x["n_shingles"], x["component_id"]) for x in ngram_join.join(d).collect())
    want = brute.components(rows)
    assert got == sorted((i, *want[i]) for i, _ in rows) and want[2][1] == 1 and want[5][1] == 4


def test_join_of_few_rows(spark):
    d = spark.createDataFrame([(None, "a b c d e f"), (5, "a b c d e f"), (5, "q"), (7, "Q"), (8, None)], "doc_id long, text string")
    got = sorted(map(str, (tuple(r) for r in ngram_join.join(d).collect())))
    assert got == sorted(map(str, [(None, 2, 5), (5, 2, 5), (5, 1, 5), (7, 1, 5), (8, 0, 8)]))
    assert ngram_join.join(d.where("false")).isEmpty()


def test_boundary_follows_cost():
    assert ngram_join.boundary({}, 80) == 0
    assert ngram_join.boundary({1: 1000, 2: 1000, 3: 1000}, 80) >= 3
    assert ngram_join.boundary({14: 1000}, 80) < 14


@given(st.integers(1, 60), st.integers(1, 60))
def test_needed_overlap(s, m):
    need = ngram_join.need(s, m, 80)
    assert 100 * need >= 80 * (s + m - need) and 100 * (need - 1) < 80 * (s + m - need + 1)
    assert (m in ngram_join.partners(s, 80)) == (need <= min(s, m))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=14))
def test_components(spark, pairs):
    parent = list(range(13))

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for a, b in pairs:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(pairs, "a int, b int")).collect()}
    assert got == {x: find(x) for x in range(13) if find(x) != x}


def cut(df, **kw):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in suffix_dedup.dedup(df, **kw).collect()}


@pytest.mark.parametrize("hot, block", [(20_000, 8_000), (3, 8_000), (20_000, 40)])
def test_repeats(spark, monkeypatch, docs, corpus, hot, block):
    spans = suffix_dedup.spans
    monkeypatch.setattr(suffix_dedup, "spans", lambda own, q, n: spans(own, q, n, hot))
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    want = brute.repeats(corpus)
    assert cut(docs) == want and sum(x[1] for x in want.values()) > 3000


def test_repeats_over_segments(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 300)
    r = random.Random(2)
    base = "".join(r.choice("abcd ") for _ in range(3000))
    rows = [(i, base[i * 37 : i * 37 + 900] + r.choice("xyz") + base[i * 11 : i * 11 + 400]) for i in range(12)] + [(50, "a" * 1000), (51, "ab" * 500)]
    assert cut(spark.createDataFrame(rows, "doc_id long, text string")) == brute.repeats(rows)


def test_repeats_at_the_limit_and_whole_characters(spark):
    t = "".join(random.Random(4).choice("abcdefgh") for _ in range(99))
    rows = [(1, t), (2, t), (3, t + "x"), (4, t + "x"), (5, None), (6, None)]
    assert cut(spark.createDataFrame(rows, "doc_id long, text string")) == brute.repeats(rows)
    rows = [(1, "é" * 60), (2, "xé" + "é" * 60 + "ñ"), (3, "é" * 49 + "w" * 70)]
    kept = {r["doc_id"]: bytes(r["kept"]).decode() for r in suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"), whole_characters=True).collect()}
    assert kept[2] == "xñ" and kept[3] == rows[2][1]


def test_repeats_of_odd_tables(spark):
    d = spark.createDataFrame([(None, "a" * 150), (2, "a" * 150), (2, "b"), (None, None)], "doc_id long, text string")
    got = sorted((r["doc_id"] is None, r["n_bytes"], r["n_removed"]) for r in suffix_dedup.dedup(d).collect())
    # what goes from one row of an id goes from all of them
    assert got == [(False, 1, 1), (False, 150, 150), (True, 0, 0), (True, 150, 149)]
    assert suffix_dedup.dedup(d.where("false")).isEmpty()


@pytest.mark.parametrize("hot", [20_000, 1])
def test_repeats_of_periodic_and_multibyte_texts(spark, monkeypatch, hot):
    spans = suffix_dedup.spans
    monkeypatch.setattr(suffix_dedup, "spans", lambda own, q, n: spans(own, q, n, hot))
    r, rows = random.Random(6), []
    unit = ["ab", "abc", "日本", "é", "x" * 33, "\U0001F600 "]
    for i in range(14):
        body = "".join(r.choice(unit) * r.randrange(1, 60) for _ in range(6))
        rows += [(2 * i, body), (2 * i + 1, "".join(r.choice("pq") for _ in range(r.randrange(40))) + body[r.randrange(30) :])]
    assert cut(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == brute.repeats(rows)


def test_slide():
    x = np.array([5, 1, 4, 4, 2, 9])
    for n in range(1, 7):
        assert list(suffix_dedup._slide(x, n, np.minimum)) == [min(x[i : i + n]) for i in range(len(x) - n + 1)]
