import pytest

from coverloom import schemas
from coverloom.operators import evaluate, report

CL = "samples string, length int, total_targets double, total_size bigint, recover_samples string, coassembly string"


def inputs(frame):
    targets = frame([("g1", "s1", "AAA", 3, 5.0, "Root; d__B; p__X", 10), ("g1", "s2_1", "AAA", 2, 6.0, "Root; d__B; p__X", 10), ("g1", "s1", "CCC", 3, 5.0, "Root; d__B; p__Y", 11), ("g1", "s3", "GGG", 1, 1.0, "Root", 12)], schemas.TARGETS)
    binned = frame([("g1", "s1_1", "TTT", 3, 5.0, "Root; d__K", "G1")], schemas.APPRAISED)
    clusters = frame([("s1,s2", 2, 2.0, 10, "s1,s2", "coassembly_0")], CL)
    edges = frame([("match", 2, "s1,s2_1", "10,11"), ("match", 2, "s1,s9", "12")], schemas.EDGES_TEXT)
    recovered = frame([("g1", "coassembly_0-genome_0", "AAA", 1, 1.0, "Root; d__B; p__X"), ("g1", "coassembly_0-genome_0", "TTT", 1, 1.0, "Root; d__K"), ("g1", "coassembly_0-genome_1", "NEW", 1, 1.0, "Root; new")], schemas.OTU)
    bins = frame([("coassembly_0-genome_0", "p"), ("coassembly_0-genome_1", "p"), ("coassembly_0-genome_2", "p")], schemas.RECOVERED_BINS)
    return targets, binned, clusters, edges, recovered, bins


def test_matches_novel_and_statistics(spark, frame):
    m, n, s = evaluate.evaluate(*inputs(frame))
    got = {(r["sequence"], r["genome"], r["target"], r["found_in"], r["source_samples"], r["source_num_hits"]) for r in m.collect()}
    assert got == {("AAA", "genome_0", "10", None, "s1,s2", 5), ("CCC", None, "11", None, "s1", 3), ("TTT", "genome_0", None, "G1", "s1", 3)}
    assert [(r["sequence"], r["genome"]) for r in n.collect()] == [("NEW", "genome_1")]
    stats = {r["statistic"]: (r["within"], r["match"], r["nonmatch"], r["total"], r["match_percent"]) for r in s.collect()}
    assert stats["sequences"] == ("targets", 1, 1, 2, 50.0)
    assert stats["taxonomy"] == ("targets", 1, 1, 2, 50.0)
    assert stats["bins"] == ("recovery", 1, 2, 3, 33.33)
    assert stats["nontarget_bin_sequences"] == ("recovery", 1, 2, 3, 33.33)
    assert stats["nontarget_unbin_sequences"][1:3] == (0, 3) and stats["novel_sequences"][1:3] == (1, 2)
    assert [r["statistic"] for r in evaluate.ordered_summary(s).limit(2).collect()] == ["sequences", "taxonomy"]


def test_nothing_recovered(spark, frame):
    t, b, c, e, r, bins = inputs(frame)
    for x, ddl in zip(evaluate.evaluate(t, b, c, e, r.where("false"), bins), (schemas.MATCHES, schemas.MATCHES, schemas.SUMMARY)):
        assert x.isEmpty() and x.columns == [w.split()[0] for w in ddl.split(", ")]


def test_aggregates_for_plots(spark, frame):
    m, _, s = evaluate.evaluate(*inputs(frame))
    assert {(r["group"], r["recovered"], r["missed"]) for r in evaluate.by_rank(m, 2).collect()} == {("p__X", 1, 0), ("p__Y", 0, 1)}
    assert [(r["gene"], r["recovered"], r["missed"]) for r in evaluate.by_gene(m).collect()] == [("g1", 1, 1)]
    w = evaluate.wide_table(s, inputs(frame)[2]).first()
    assert (w["sequences"], w["bins"], w["novel_sequences"]) == (1, 1, 1)


@pytest.mark.parametrize("name, want", [("coassembly_0-genome_1", ("coassembly_0", "genome_1")), ("x_coassembly_3.12", ("coassembly_3", "12")), ("it_0-co_1-2", ("it_0", "co_1")), ("a", ("a", None))])
def test_bin_names(spark, frame, name, want):
    r = evaluate.split_name(frame([(name,)], "sample string")).first()
    assert (r["coassembly"], r["genome"]) == want


def plan(frame):
    return frame([("a,b", 2, 3.0, 30, "a,b,c", "coassembly_0"), ("c,d", 2, 1.0, 20, "d,c,a", "coassembly_1")], CL)


def test_summary_with_and_without_sizes(spark, frame):
    assert report.coassembly_summary(plan(frame)).columns == ["coassembly", "samples", "length", "total_targets", "total_size"]
    got = {r["coassembly"]: r["unmapped_size"] for r in report.coassembly_summary(plan(frame), frame([("a", 5), ("b", 6)], schemas.READ_SIZE)).collect()}
    assert got == {"coassembly_0": 11, "coassembly_1": 0}


def test_single_ended_samples(spark, frame):
    got = [(r["samples"], r["recover_samples"]) for r in report.drop_single_ended(plan(frame), ["b", "a"]).collect()]
    assert got == [("c,d", "c,d")]
    with pytest.raises(ValueError):
        report.drop_single_ended(plan(frame), ["a", "c"])


def test_commands_keep_the_trailing_space(spark, frame):
    reads = frame([(s, f"/r/{s}.1", f"/r/{s}.2") for s in "abc"], "sample string, r1 string, r2 string")
    r = report.commands(plan(frame), reads, "out", 1, 2, 3, 4, fast=True, program="asm").orderBy("coassembly").collect()
    assert r[0]["assemble"] == "asm assemble --coassemble -1 /r/a.1 /r/b.1 -2 /r/a.2 /r/b.2 --output out/coassemble/coassembly_0/assemble -n 1 -t 1 -m 2 --skip-qc &> out/coassemble/logs/coassembly_0_assemble.log "
    assert "-1 d /r/c.1 /r/a.1 -2 d /r/c.2 /r/a.2" in r[1]["recover"] and " --binning-only --refinery-max-iterations 0 -n 3 -t 3 -m 4 " in r[1]["recover"]


def test_operational_reports(spark, frame):
    done = frame([("x", "c0", True, True), ("x", "c1", True, False), ("y", "c0", False, False)], "dir string, coassembly string, assembled boolean, recovered boolean")
    got = {r["dir"]: tuple(r)[1:] for r in report.completion(done).collect()}
    assert got == {"x": (2, 2, 1, 1), "y": (1, 0, 0, 1), "2": (3, 2, 1, 2)}
    assert report.incomplete(done).count() == 2
    assert [r["coassembly"] for r in report.suggested_before(plan(frame), frame([("c,d",)], "samples string")).collect()] == ["coassembly_1"]
    assert {r["sample"] for r in report.recovery_samples(plan(frame)).collect()} == {"a", "b", "c", "d"}
    assert [tuple(r) for r in report.length_histogram(plan(frame)).collect()] == [(2, 2)]
    assert report.exclusions(plan(frame), plan(frame)).count() == 2
