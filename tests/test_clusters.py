import random

import pytest
from pyspark.sql import functions as F

from coverloom import schemas, scratch
from coverloom.operators import clusters, edges, precluster
from coverloom.params import Params
from coverloom.plans import assemble


def E(frame, data):
    """data: (style, size, samples, ids)"""
    return frame([(st, n, s.split(","), [int(i) for i in t.split(",")]) for st, n, s, t in data], schemas.EDGES)


def sizes(frame, **kw):
    return frame([(k, v) for k, v in kw.items()] or [("none", 1)], schemas.READ_SIZE)


def plan(frame, data, p=Params(min_cluster_targets=1), **kw):
    got = assemble.choose(E(frame, data), sizes(frame, **kw), p)
    return [tuple(r[c] for c in ("samples", "length", "total_targets", "recover_samples", "coassembly")) for r in got.orderBy("coassembly").collect()]


def test_the_better_of_two_overlapping_pairs(spark, frame):
    got = plan(frame, [("match", 2, "a,b", "1,2,3"), ("match", 2, "b,c", "3,4")], a=10, b=10, c=10)
    assert got == [("a,b", 2, 3.0, "a,b,c", "coassembly_0")]


def test_components_are_ranked(spark, frame):
    got = plan(frame, [("match", 2, "a,b", "1"), ("match", 2, "b,c", "2"), ("match", 2, "d,e", "3,4,5")], a=1, b=1, c=9, d=1, e=1)
    assert [g[0] for g in got] == ["d,e", "a,b"]


def test_one_disjoint_family_for_each_size(spark, frame):
    data = [("match", 2, "a,b", "1,2"), ("match", 2, "c,d", "1"), ("pool", 3, "a,b,c,d", "5,6,7")]
    got = plan(frame, data, Params(num_samples=2, max_samples=3, min_cluster_targets=1), a=1, b=1, c=1, d=1)
    assert sorted(g[1] for g in got) == [2, 2, 3]


def test_large_pools_only_add_targets(spark, frame):
    data = [("match", 2, "a,b", "1"), ("pool", 3, "a,b,c", "2"), ("pool", 3, "a,b,c,d,e", "3,4")]
    got = plan(frame, data, Params(num_samples=2, max_samples=3, max_sample_combinations=4, min_cluster_targets=1), a=1)
    assert ("a,b,c", 3, 3.0) in [g[:3] for g in got] and len([g for g in got if g[1] == 3]) == 1


def test_limits_on_size_targets_and_samples(spark, frame):
    data = [("match", 2, "a,b", "1,2,3"), ("match", 2, "c,d", "4")]
    assert [g[0] for g in plan(frame, data, Params(max_size_gbp=1e-9, min_cluster_targets=1), a=9, c=1)] == ["c,d"]
    assert [g[0] for g in plan(frame, data, Params(min_cluster_targets=2))] == ["a,b"]
    assert [g[0] for g in plan(frame, data, Params(coassembly_samples=("c", "d"), min_cluster_targets=1))] == ["c,d"]
    assert [g[0] for g in plan(frame, data, Params(exclude=("b,a",), min_cluster_targets=1))] == ["c,d"]
    assert [g[0] for g in plan(frame, data, Params(anchor_samples=("d",), min_cluster_targets=1))] == ["c,d"]


def test_weights_replace_counts(spark, frame):
    e = E(frame, [("match", 2, "a,b", "1,2"), ("match", 2, "b,c", "3")])
    w = frame([(3, 0.9), (1, 0.1)], schemas.TARGET_WEIGHTS)
    got = assemble.choose(e, sizes(frame), Params(min_cluster_targets=1), w).collect()
    assert [(r["samples"], r["total_targets"]) for r in got] == [("b,c", 0.9)]
    assert assemble.choose(e, sizes(frame), Params(min_cluster_targets=1), w.where("weight > 2")).isEmpty()


def test_single_mode_names_by_sample(spark, frame):
    data = [("directional", 2, "a,b", "1,2"), ("singleton", 1, "a", "7"), ("directional", 2, "b,a", "1")]
    got = plan(frame, data, Params(min_cluster_targets=1).single())
    assert [(g[0], g[2], g[3], g[4]) for g in got] == [("a", 3.0, "a,b", "a"), ("b", 1.0, "a,b", "b")]


def test_repeated_targets_count_in_the_score(spark, frame):
    c = clusters.pooled(E(frame, [("pool", 3, "a,b,c", "1,2"), ("pool", 3, "a,b,c,d", "2")]))
    got = {r["key"]: r["target_ids"] for r in c.collect()}
    assert sorted(got["a,b,c"]) == [1, 2, 2] and got["b,c,d"] == [2] and len(got) == 4


@pytest.mark.parametrize("most", [1, 4, 30, 500])
def test_recovery_by_bounds_is_the_same(spark, frame, most):
    """A few targets are in all samples, most in a few; sets with repeated, unknown and no targets."""
    rng = random.Random(most)
    st = {(f"s{i:03}", t) for i in range(300) for t in range(5)} | {(f"s{min(int(rng.expovariate(0.1)), 299):03}", t) for t in range(5, 60) for _ in range(25)}
    st = frame(sorted(st), "candidate string, target long")
    sets = [list(range(60)), list(range(5)), [1, 7, 7, 9, 900, 901], [900, 901], [], rng.sample(range(60), 20), [3, 8]]
    chosen = frame([(f"k{i}", x) for i, x in enumerate(sets)], "key string, target_ids array<bigint>")
    plain, bounded = ({r["key"]: r["recover_candidates"] for r in clusters.recovery(chosen, st, most, b).collect()} for b in (False, True))
    assert bounded == plain and len(plain) == len(sets)


def test_recovery_by_bounds_reads_a_tenth_of_a_skewed_table(spark, frame):
    st = spark.sql("select concat('s', id) as candidate, t as target from range(20000) lateral view explode(sequence(0, 9)) x as t union all select concat('s', id), t from range(30) lateral view explode(sequence(10, 59)) x as t")
    chosen = frame([("k", list(range(60)))], "key string, target_ids array<bigint>")
    each = chosen.selectExpr("key", "explode(target_ids) as target")
    counts = {r["candidate"]: r["n"] for r in clusters._bounded_counts(each, st, 20).collect()}
    assert counts == {f"s{i}": 60 for i in range(30)}
    lists = clusters._by_frequency(each, st, 0.75)
    met = lists.where("rare").join(st, "target").count() + len(counts) * lists.where("not rare").count()
    assert 10 * met < each.join(st, "target").count()


def _pools(seed=3):
    rng = random.Random(seed)
    for i in range(40):
        n = rng.choice([3, 3, 4])
        who = sorted({f"s{min(int(rng.expovariate(0.25)), 14):02}" for _ in range(9)})
        if len(who) >= n:
            yield "pool", n, ",".join(who), ",".join(str(100 * i + k) for k in range(rng.randrange(1, 4)))


@pytest.mark.parametrize("least", [2, 5, 12, 1_000])
def test_support_bounds_lose_no_combination(spark, frame, least):
    e = E(frame, list(_pools()))
    plain = {r["key"]: sorted(r["target_ids"]) for r in clusters.pooled(e, 2, 1).collect()}
    got = {r["key"]: sorted(r["target_ids"]) for r in clusters.pooled(e, 2, least).collect()}
    assert got == {k: v for k, v in plain.items() if len(v) >= least}


def test_extra_targets_are_those_of_pools_that_hold_the_set(spark, frame):
    data = list(_pools(9))
    chosen = [["s00", "s01", "s02"], ["s03", "s05", "s07"], ["s00", "s04", "nowhere"], ["s00", "s01", "s02", "s03"]]
    rows = frame([(",".join(c), len(c), c, [7, 7]) for c in chosen], "key string, length int, samples array<string>, target_ids array<bigint>")
    got = {r["key"]: sorted(r["target_ids"]) for r in clusters.extra_targets(rows, E(frame, data), 4).collect()}
    for c in chosen:
        big = [t for _, n, who, t in data if n == len(c) and len(who.split(",")) > 4 and set(c) <= set(who.split(","))]
        assert got[",".join(c)] == sorted({7, *(int(i) for t in big for i in t.split(","))})
    assert any(len(v) > 1 for v in got.values())


def test_a_set_meets_few_of_the_pools_of_its_rarest_sample(spark, frame, monkeypatch):
    """400 pools of 12 among 60 samples: each sample is in about 80, each pair in 15, and joins of small pools go by pairs; large pools are met by the rarest sample, with the same result."""
    r = random.Random(3)
    data = [("pool", 3, ",".join(sorted(r.sample([f"s{i:02}" for i in range(60)], 12))), str(i)) for i in range(400)]
    chosen = [sorted(r.sample([f"s{i:02}" for i in range(60)], 3)) for _ in range(300)]
    rows = frame([(c, 3, c.split(","), [9_999]) for c in sorted({",".join(c) for c in chosen})], "key string, length int, samples array<string>, target_ids array<bigint>")
    want = {c: sorted([9_999, *(int(t) for _, _, who, t in data if set(c.split(",")) <= set(who.split(",")))]) for (c,) in rows.select("key").collect()}
    join, met = type(rows).join, []
    monkeypatch.setattr(type(rows), "join", lambda self, other, *a: (met.append(self) if a == ("pool",) and "rest" in self.columns else None, join(self, other, *a))[1])
    for paired in (64, 0):
        assert {x["key"]: sorted(x["target_ids"]) for x in clusters.extra_targets(rows, E(frame, data), 4, paired).collect()} == want
    assert met[0].count() * 4 < met[1].count() and any(len(v) > 1 for v in want.values())


def test_greedy_in_one_task_and_in_rounds_agree(spark, frame):
    r = random.Random(5)
    rows = []
    for _ in range(150):
        s = sorted(r.sample("abcdefghijklmnopqrstuvwxyz", r.choice([2, 3])))
        rows.append((",".join(s), s, len(s), float(r.randrange(4)), r.randrange(3)))
    rows = list({x[0]: x for x in rows}.values())
    c = frame(rows, "key string, samples array<string>, length int, total_targets double, total_size bigint")
    want, used = set(), {2: set(), 3: set()}
    for key, s, n, *_ in sorted(rows, key=lambda x: (-x[3], x[4], x[0])):
        if not used[n] & set(s):
            used[n] |= set(s)
            want.add(key)
    assert {x["key"] for x in clusters.greedy(c).collect()} == want
    assert {x["key"] for x in clusters.greedy(c, one_task=0).collect()} == want
    assert {x["key"] for x in clusters.greedy(c, one_task=1).collect()} == want
    assert {x["key"] for x in clusters.greedy(c, one_task=40).collect()} == want


def test_a_long_chain_of_conflicts_ends_in_few_rounds(spark, frame, monkeypatch):
    """Each candidate shares a sample with the next one in the order: every second one is taken."""
    n = 10_000
    c = spark.range(n).selectExpr("concat('s', lpad(id, 6, '0'), ',s', lpad(id + 1, 6, '0')) as key", "2 as length", f"cast({n} - id as double) as total_targets", "0L as total_size")
    c = c.withColumn("samples", F.split("key", ","))
    rounds = []
    monkeypatch.setattr(clusters, "cut", lambda df, label="cut": rounds.append(label) or scratch.cut(df, label))
    got = {r["key"] for r in clusters.greedy(c, one_task=3_000).collect()}
    assert got == {f"s{i:06},s{i + 1:06}" for i in range(0, n, 2)} and rounds.count("wins") <= 5


def test_rounds_drop_conflicting_candidates_without_a_shuffle(spark, frame, monkeypatch):
    c = frame([(f"s{i},s{i + 1}", [f"s{i}", f"s{i + 1}"], 2, float(-i), 0) for i in range(6)], "key string, samples array<string>, length int, total_targets double, total_size bigint")
    plans = []
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(clusters, "cut", lambda df, label="cut": (plans.append(plan(df)) if label == "alive" else None, scratch.cut(df, label))[1])
    assert {r["key"] for r in clusters.greedy(scratch.cut(c), one_task=0).collect()} == {"s0,s1", "s2,s3", "s4,s5"}
    assert len(plans) == 4 and not any("Generate" in p or "SortMergeJoin" in p for p in plans)  # no row for each sample of a candidate


def test_recovery_counts_shared_targets(spark, frame):
    c = frame([("a,b", [1, 2, 9])], "key string, target_ids array<bigint>")
    st = frame([("a", 1), ("a", 2), ("c", 2), ("d", 2)], "candidate string, target bigint")
    got = clusters.recovery(c, st, 2).first()["recover_candidates"]
    assert got == ["a", "c"]
    assert clusters.recovery(c, st, 9).first()["recover_candidates"] == ["a", "c", "d", None]


def test_threshold_of_targets(spark, frame):
    e = E(frame, [("match", 2, "a,b", "1")] * 3)
    assert clusters.min_targets(e) == 1 and clusters.min_targets(e, few=2) == 10


def test_no_edges_give_no_clusters(spark, frame):
    got = assemble.choose(E(frame, []), sizes(frame), Params())
    assert got.isEmpty() and got.columns == ["samples", "length", "total_targets", "total_size", "recover_samples", "coassembly"]


def test_jaccard_of_sketches(spark, frame):
    k = frame([(s, x) for s, xs in {"a": "pq", "b": "pq", "c": "pqr", "d": "xyz", "e": "pxy"}.items() for x in xs], "sample string, kmer string")
    got = {(r["query_name"], r["match_name"]): round(r["jaccard"], 2) for r in precluster.jaccard(k, 0.3).collect()}
    assert got == {("a", "b"): 1.0, ("a", "c"): 0.67, ("b", "c"): 0.67, ("d", "e"): 0.5}


@pytest.mark.parametrize("hot, block, threshold", [(0, 3, 0.1), (4, 2, 0.3), (6, 50, 0.0), (9, 4, 0.2)])
def test_jaccard_by_blocks(spark, frame, hot, block, threshold):
    """K-mers that many or all samples share, compared by blocks, give what they give as a join."""
    r = random.Random(hot)
    rows = [(f"s{i}", f"k{j}") for i in range(14) for j in range(40) if j < 3 or r.random() < (0.9 if j < 12 else 0.15) and i % 5 or j == 100 + i]
    rows += [("lone", "only"), ("s0", "x")]
    sets = {}
    for s, k in rows:
        sets.setdefault(s, set()).add(k)
    want = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in sets if a < b and sets[a] & sets[b]}
    want = {k: round(v, 9) for k, v in want.items() if v >= threshold}
    k = frame(rows, "sample string, kmer string")
    got = [(x["query_name"], x["match_name"], round(x["jaccard"], 9)) for x in precluster.jaccard(k, threshold, hot, block).collect()]
    assert {(a, b): v for a, b, v in got} == want and len(got) == len(want)


def test_sketch_is_canonical_and_clean(spark, frame):
    o = frame([("g", "a", "AC-GT", 1, 1.0, "r"), ("g", "b", "ACTGT", 1, 1.0, "r"), ("g", "c", "AC", 1, 1.0, "r")], schemas.OTU)
    got = {(r["sample"], r["kmer"]) for r in precluster.sketch(o, 5).collect()}
    assert got == {("a", "ACAGT"), ("b", "ACAGT")} or got == {("a", "ACAGT"), ("b", min("ACTGT", "ACAGT"))}


def D(frame, data):
    return frame([(a, b, j) for a, b, j in data], "query_name string, match_name string, jaccard double")


def sets(df):
    return {",".join(r["samples"]) for r in df.collect()}


def test_nearest_neighbour_pairs(spark, frame):
    d = D(frame, [("1", "2", 0.9), ("2", "3", 0.5), ("1", "3", 0.1)])
    assert sets(precluster.preclusters(d, 2, 2)) == {"1,2", "2,3"}


def test_dissimilar_samples_fill_up(spark, frame):
    d = D(frame, [("1", "2", 0.9), ("2", "3", 0.5)])
    assert sets(precluster.preclusters(d, 3, 2)) == {"1,2", "2,3", "1,3"}


def test_too_few_samples_lower_the_size(spark, frame):
    assert sets(precluster.preclusters(D(frame, [("1", "2", 0.9), ("2", "3", 0.5)]), 9, 2)) == {"1,2", "2,3"}


def test_neighbours_of_none_and_of_few(spark, frame):
    near, _ = precluster.neighbours(D(frame, []), 5, lower=False)
    assert near.isEmpty() and precluster.neighbours(D(frame, []), 5)[1] == 0
    near, _ = precluster.neighbours(D(frame, [("1", "2", 0.9), ("2", "3", 0.5)]), 5, lower=False)
    assert {r["sample"]: r["nearest"] for r in near.collect()} == {"1": ["3", "2"], "2": ["3", "1"], "3": ["1", "2"]}


def test_jaccard_makes_no_row_for_each_pair_of_a_kmer(spark, frame):
    near = precluster.jaccard(frame([(f"s{i}", k) for i in range(9) for k in ("a", f"k{i}")], "sample string, kmer string"))
    plan = near._jdf.queryExecution().optimizedPlan().toString()
    assert len(near.collect()) == 36 and "Generate explode(rest" in plan and not any("Join" in x and "kmer" in x for x in plan.splitlines())


def test_anchors_are_centres(spark, frame):
    d = D(frame, [("1", "2", 0.9), ("2", "3", 0.5), ("3", "4", 0.8)])
    assert sets(precluster.preclusters(d, 2, 2, ["4"])) == {"3,4"}
    assert precluster.preclusters(D(frame, []), 2, 2).isEmpty()


@pytest.mark.parametrize("pre", ["never", "always"])
def test_end_to_end(spark, frame, pre):
    o = [("g", s, q, 1, c, "Root", None) for s, q, c in [("a", "x" * 60, 8.0), ("b", "x" * 60, 8.0), ("c", "y" * 60, 9.0), ("d", "y" * 60, 9.0), ("e", "z" * 60, 99.0)]]
    u = frame(o, schemas.APPRAISED)
    p = Params(kmer_precluster=pre, precluster_size=2, min_cluster_targets=1)
    got = assemble.plan(u, u.where("false"), sizes(frame), p)
    assert {r["samples"] for r in got.clusters.collect()} == {"a,b", "c,d"}
    assert [r["sample"] for r in got.unused.collect()] == ["e"]
    new, again = assemble.iterate(u, u.where("false"), sizes(frame), p, ["a,b"], got.clusters.where("samples = 'a,b'"))
    assert {r["samples"] for r in new.clusters.collect()} == {"c,d"} and again.isEmpty()


def test_edges_module_has_stable_columns(spark, frame):
    assert edges.multi(frame([], schemas.TARGETS), 10, 3).columns == edges.EDGE


def test_parameters():
    assert Params(max_recovery_samples=20).neighbours == 100 and Params().single().largest == 1 and Params().single().max_size is None
    assert [Params().combinations_at(i) for i in (1, 2, 5)] == [100, 75, 1]
    assert Params().preclusters(1001) and not Params().preclusters(1000)
    with pytest.raises(ValueError):
        Params(num_samples=3, max_samples=2)
