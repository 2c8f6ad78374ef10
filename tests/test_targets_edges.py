"""Targets, weights and edges on small hand-written tables."""

import random

import pytest
from pyspark.sql import functions as F

from coverloom import schemas
from coverloom.operators import blocks, edges, targets


def otu(frame, data, found=None):
    """data: (gene, sample, sequence, coverage)"""
    return frame([(g, s, q, 1, float(c), "Root; d__Bacteria; p__X") for g, s, q, c in data], schemas.OTU)


def tgt(frame, data):
    """data: (sample, target, coverage)"""
    return frame([("g", s, f"q{t}", 1, float(c), "Root", t) for s, t, c in data], schemas.TARGETS)


def edge_set(df):
    return {(r["style"], r["cluster_size"], r["samples"], r["target_ids"]) for r in edges.to_text(df).collect()}


def test_dense_ids_number_sequences_in_order(spark, frame):
    t = targets.dense(otu(frame, [("g1", "a", "T", 1), ("g1", "b", "A", 1), ("g2", "a", "A", 1), ("g1", "c", "T", 1)]))
    got = {(r["gene"], r["sequence"]): r["target"] for r in t.collect()}
    assert got == {("g1", "A"): 0, ("g1", "T"): 1, ("g2", "A"): 2}


def test_dense_ids_follow_first_appearance(spark, frame):
    t = otu(frame, [("g1", "a", "T", 1), ("g1", "b", "A", 1)]).selectExpr("*", "case when sequence = 'T' then 0 else 1 end as i")
    assert {r["sequence"]: r["target"] for r in targets.dense(t, row_index="i").collect()} == {"T": 0, "A": 1}


def test_hashed_ids_are_not_negative_and_tell_sequences_apart(spark, frame):
    t = targets.hashed(otu(frame, [(f"g{i % 7}", "a", f"s{i}", 1) for i in range(200)])).collect()
    assert len({r["target"] for r in t}) == 200 and min(r["target"] for r in t) >= 0


@pytest.mark.parametrize("samples", [["a"], "frame"])
def test_samples_and_taxa_are_chosen(spark, frame, samples):
    t = otu(frame, [("g", "a", "x", 1), ("g", "b", "y", 1)])
    who = frame([("a",)], "sample string") if samples == "frame" else samples
    assert [r["sample"] for r in targets.chosen(t, who).collect()] == ["a"]
    assert targets.chosen(t, taxa="p__Y|p__Z").isEmpty()


def test_pairs_need_coverage_over_the_minimum_together(spark, frame):
    t = tgt(frame, [("s1", 1, 6), ("s2", 1, 4), ("s1", 2, 6), ("s2", 2, 5), ("s3", 2, 4), ("s3", 3, 99)])
    assert edge_set(edges.pairs(t, 10)) == {("match", 2, "s1,s2", "2")}
    assert edge_set(edges.pairs(t, 8)) == {("match", 2, "s1,s2", "1,2"), ("match", 2, "s1,s3", "2"), ("match", 2, "s2,s3", "2")}


def test_ids_are_sorted_as_text(spark, frame):
    t = tgt(frame, [(s, i, 50) for s in ("1", "10") for i in (2, 10, 9)])
    assert edge_set(edges.pairs(t)) == {("match", 2, "1,10", "10,2,9")}


def test_pools_take_all_samples_over_their_share(spark, frame):
    t = tgt(frame, [(s, 1, 4) for s in "abcd"] + [(s, 2, 3) for s in "abcd"])
    assert edge_set(edges.pools(t, 10, 4)) == {("pool", 3, "a,b,c,d", "1"), ("pool", 4, "a,b,c,d", "1,2")}


def test_single_mode_directional_and_singleton(spark, frame):
    t = tgt(frame, [("a", 1, 20), ("b", 1, 2), ("a", 2, 20), ("b", 3, 1)])
    assert edge_set(edges.single(t, 10)) == {("directional", 2, "a,b", "1"), ("singleton", 1, "a", "2")}


def _skewed(frame, seed=5):
    """One target in all samples, some in a few; equal coverages, a repeated row, nulls."""
    rng = random.Random(seed)
    data = [(f"s{i:03}", 1, rng.choice([0.5, 1, 2, 4, 4.5, 5, 5.5, 6, 9, 12])) for i in range(150)]
    data += [(f"s{rng.randrange(150):03}", t, rng.choice([3, 6, 11])) for t in range(2, 40) for _ in range(rng.randrange(1, 6))]
    rows = [("g", s, f"q{t}", 1, float(c), "Root", t) for s, t, c in [*data, data[0]]]
    return frame([*rows, ("g", "s000", "q1", 1, None, "Root", 1), ("g", None, "q1", 1, 20.0, "Root", 1), ("g", "s001", "q", 1, 20.0, "Root", None)], schemas.TARGETS)


@pytest.mark.parametrize("block", [1, 7, 1_000])
def test_hot_targets_by_blocks_give_the_same_pairs(spark, frame, block):
    t = _skewed(frame)
    assert edge_set(edges.pairs(t, 10, 20, block)) == edge_set(edges.pairs(t, 10))
    assert edge_set(edges.single(t, 10, 20, block)) == edge_set(edges.single(t, 10))


def test_pairs_of_blocks_that_cannot_reach_the_minimum_are_not_made(spark, frame):
    low = [(f"s{i:05}", 1, 1) for i in range(3_000)]
    t = tgt(frame, [*low, ("x", 1, 30), ("y", 1, 9.5)]).select("target", "sample", "coverage")
    assert {r["tops"][0] for r in blocks._blocked(t, 100).select("tops").distinct().collect()} == {30.0}
    got = blocks.match(t, 10, 100)
    assert got.where("s1 <> 'x' and s2 <> 'x' and s1 <> 'y' and s2 <> 'y'").isEmpty() and got.count() == 3_000 * 2 + 1
    assert {r["n"] for r in blocks._blocked(t, 100).groupBy("block").agg(F.count(F.lit(1)).alias("n")).collect()} == {100, 2}


def test_preclustered_edges_need_every_member(spark, frame):
    t = tgt(frame, [("a", 1, 6), ("b", 1, 6), ("c", 1, 6), ("a", 2, 20), ("b", 2, 20), ("a", 3, 1), ("b", 3, 1), ("c", 3, 1)])
    sets = frame([(["a", "b", "c"],), (["a", "b"],)], "samples array<string>")
    assert edge_set(edges.preclustered(sets, t, 10)) == {("match", 3, "a,b,c", "1"), ("match", 2, "a,b", "1,2")}


def test_preclustered_single_mode_keeps_targets_no_neighbour_has(spark, frame):
    t = tgt(frame, [("a", 1, 20), ("b", 1, 2), ("c", 1, 2), ("a", 2, 20), ("c", 2, 20)])
    got = edge_set(edges.preclustered_single(frame([(["a", "b"],)], "samples array<string>"), t, min_coverage=10))
    assert got == {("directional", 2, "a,b", "1"), ("singleton", 1, "a", "2"), ("singleton", 1, "c", "2")}


def test_no_rows_give_no_edges(spark, frame):
    t = tgt(frame, [])
    assert edges.multi(t, 10, 4).isEmpty() and edges.single(t).isEmpty()
    assert edges.multi(t, 10, 4).columns == edges.EDGE


def test_edges_survive_text(spark, frame):
    t = tgt(frame, [(s, i, 50) for s in ("b", "a") for i in (2, 10)])
    e = edges.pairs(t)
    assert edge_set(edges.from_text(edges.to_text(e))) == edge_set(e)


def test_unused_samples(spark, frame):
    e = frame([("match", 2, ["a", "b"], [1])], schemas.EDGES)
    assert [r["sample"] for r in edges.unused_samples(frame([("a",), ("c",)], "sample string"), e).collect()] == ["c"]


def test_weights_average_over_samples_that_have_the_gene(spark, frame):
    unbinned = frame([("g", "s1", "x", 1, 5.0, "r", None), ("g", "s2", "y", 1, 4.0, "r", None)], schemas.APPRAISED)
    binned = frame([("g", "s1", "z", 1, 5.0, "r", "G"), ("h", "s3", "z", 1, 5.0, "r", "G")], schemas.APPRAISED)
    w = {r["sequence"]: r["weight"] for r in targets.abundance_weights(unbinned, binned).collect()}
    assert w == pytest.approx({"x": 0.25, "y": 0.5})
    only = {r["sequence"]: r["weight"] for r in targets.abundance_weights(unbinned, binned, ["s1"]).collect()}
    assert only == pytest.approx({"x": 0.5})


def test_synthetic_grid_of_the_baseline(spark, frame):
    data = [(f"s{s}", g * 10 + q, 5.1) for g in range(3) for s in range(8) for q in range(10)]
    e = edges.multi(tgt(frame, data), 10, 4).collect()
    assert sum(r["style"] == "match" for r in e) == 28 and {r["cluster_size"] for r in e if r["style"] == "pool"} == {3, 4}


@pytest.mark.parametrize("samples", [None, ["s0", "s2", "s5"]])
def test_weights_are_those_of_all_sequences_in_all_samples_of_their_gene(spark, frame, samples):
    """Held against the mean over the whole product; a sequence that stands in a sample twice counts twice."""
    rows = [(f"g{i % 3}", f"s{i * i % 7}", f"q{i * 5 % 11}", 1 + i % 4) for i in range(60)]
    known = [(f"g{i % 2}", f"s{i % 9}", "k", 3) for i in range(15)]
    total = {}
    for g, s, q, c in rows + known:
        if samples is None or s in samples:
            total[g, s] = total.get((g, s), 0) + c
    want = {}
    for g, q in {(g, q) for g, _, q, _ in rows}:
        each = []
        for h, s in total:
            if h == g:
                each += [c / total[g, s] for x, y, z, c in rows if (x, y, z) == (g, s, q)] or [0.0]
        if sum(each):
            want[g, q] = sum(each) / len(each)
    got = targets.abundance_weights(otu(frame, rows), otu(frame, known), samples).collect()
    assert {(r["gene"], r["sequence"]): pytest.approx(r["weight"]) for r in got} == want and len(got) == len(want)
