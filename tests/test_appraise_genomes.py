import pytest

from coverloom import schemas
from coverloom.operators import appraise, genomes, reads


def obs(frame, data):
    return frame([("g", s, q, 1, 1.0, "r") for s, q in data], schemas.OTU)


def hits(frame, data):
    """data: (sample, sequence, divergence, genome)"""
    return frame([(s, q, d, 1, 9.0, g, "g", q, "other") for s, q, d, g in data], schemas.QUERY_HITS)


def test_divergence_at_the_boundary_is_binned(spark, frame, rows):
    o = obs(frame, [("s", "a"), ("s", "b"), ("s", "c")])
    b, u = appraise.by_query(hits(frame, [("s", "a", 3, "G1"), ("s", "b", 4, "G1")]), o, 0.94, 60)
    assert [r["sequence"] for r in b.collect()] == ["a"] and {r["sequence"] for r in u.collect()} == {"b", "c"}
    assert u.columns == b.columns and all(r["found_in"] is None for r in u.collect())


def test_genomes_are_a_sorted_list(spark, frame):
    b, _ = appraise.by_query(hits(frame, [("s", "a", 1, "G2"), ("s", "a", 1, "G1")]), obs(frame, [("s", "a")]))
    assert b.first()["found_in"] == "G1,G2"


def test_empty_query_leaves_both_empty(spark, frame):
    b, u = appraise.by_query(hits(frame, []), obs(frame, [("s", "a")]))
    assert b.isEmpty() and u.isEmpty() and u.columns == b.columns


def test_no_genomes_drops_the_bad_marker(spark, frame):
    t = frame([(appraise.BAD_MARKER, "s", "a", 1, 1.0, "r"), ("g", "s", "a", 1, 1.0, "r")], schemas.OTU)
    b, u = appraise.no_genomes(t)
    assert b.isEmpty() and [(r["gene"], r["found_in"]) for r in u.collect()] == [("g", "")]


def test_marker_filter_looks_at_the_whole_line(spark, frame):
    t = frame([("g", "s", "a", 1, 1.0, "r; bad"), ("bad", "s", "a", 1, 1.0, "r"), ("g", "s", "a", 1, 1.0, "r")], schemas.OTU)
    assert appraise.drop_marker(t, "bad").count() == 1


def test_trimmed_mean_drops_a_genome_of_one_gene(spark, frame):
    data = [(f"g{i}", "s", "q", 1, 10.0, "r", "A_protein,B" if i == 0 else "A_protein") for i in range(10)]
    got = {r["genome"] for r in genomes.reference_bins(frame(data, schemas.APPRAISED), frame([], schemas.APPRAISED)).collect()}
    assert got == {"A"}


def test_samples_with_few_binned_hits_have_no_genomes(spark, frame):
    b = frame([("g", "s", "q", 1, 10.0, "r", "A")], schemas.APPRAISED)
    u = frame([("g", "s", "x", 99, 10.0, "r", None)], schemas.APPRAISED)
    assert genomes.reference_bins(b, u).isEmpty()


def test_bins_by_quality(spark, frame):
    t = frame([("a", "70", "10"), ("b", "69.9", "0"), ("c", "99", "10.1"), ("d", "n/a", "1"), ("e", None, "1")], schemas.BIN_QUALITY)
    assert [r["Name"] for r in genomes.good_bins(t).collect()] == ["a"]


def test_recovered_bins_are_renamed(spark, frame):
    t = frame([("coassembly_0", 0, "metabat_bin.1"), ("coassembly_0", 1, "odd.2")], "coassembly string, index bigint, Name string")
    got = sorted((r["new_name"], r["binner"]) for r in genomes.recovered_bins(t, "in", "out").collect())
    assert got == [("recovered_coassembly_0.1", "metabat"), ("recovered_coassembly_0.2", None)]


def test_assemblies_are_reconciled(spark, frame):
    missing, extra = genomes.reconcile_assemblies(frame([("a",), ("b",)], "sample string"), frame([("b", "x"), ("c", "y")], schemas.PRIOR_ASSEMBLIES))
    assert [r[0] for r in missing.collect()] == ["a"] and [r[0] for r in extra.collect()] == ["c"]


def test_runs_of_representatives(spark, frame):
    t = frame(list(enumerate(["a", "a", None, None, "b", "a"])), "i bigint, representative string")
    assert genomes.representatives(t) == 4


def test_fasta_headers_get_the_bin(spark, frame):
    t = frame([("b", ">c1 x"), ("b", "ACGT")], "bin string, value string")
    assert [r["value"] for r in genomes.prefixed_fasta(t).collect()] == [">b~c1 x", "ACGT"]


@pytest.mark.parametrize(
    "names, ok, reason",
    [
        (["r1 x", "r2 x", "r3 y", "r4 y"], True, "Duplicate read names in consecutive reads with even readcount"),
        (["r1 x", "r2 x", "r3 y"], False, "Odd readcount"),
        (["r1 x", "r2 z", "r3 y", "r4 y"], False, "Consecutive reads do not match (1/2)"),
    ],
)
def test_interleaving(spark, frame, names, ok, reason):
    r = frame([("s", n, i + 1) for i, n in enumerate(names)], "sample string, read string, number bigint")
    got = reads.interleaved(r, frame([("s", len(names))], "sample string, n bigint")).first()
    assert (got["interleaved"], got["reason"]) == (ok, reason)


def test_empty_file_is_not_interleaved(spark, frame):
    got = reads.interleaved(frame([], "sample string, read string, number bigint"), frame([("s", 0)], "sample string, n bigint")).first()
    assert (got["interleaved"], got["reason"]) == (False, "Empty file")


def test_read_lines(spark, frame):
    lines = frame([("s", i + 1, v) for i, v in enumerate(["@a 1", "ACGT", "+", "!!!!", "@b 1", "AC", "+", "!!"])], "sample string, line_no bigint, value string")
    assert reads.base_pairs(lines).first()["read_size"] == 6
    assert [(r["read"], r["number"]) for r in reads.headers(lines).orderBy("number").collect()] == [("@a 1", 1), ("@b 1", 2)]
    first, second = reads.deinterleave(lines)
    assert [r["value"] for r in first.collect()][0] == "@a 1" and [r["value"] for r in second.collect()][0] == "@b 1"
    assert reads.ends(reads.headers(lines), 1, 1).count() == 2


def test_sample_names(frame):
    assert reads.sample_names(["x/a_1.fastq.gz", "b.1.fq", "c_R1.fa", "d.txt"]) == {"a_1": "x/a_1.fastq.gz", "b.1": "b.1.fq", "c_R1": "c_R1.fa", "d.txt": "d.txt"}
    pairs = [("x/b.1.fq", "x/b.2.fq"), ("x/a_1.fq.gz", "y/a_2.fq.gz"), ("c_R1.fq", "c_R2.fq"), ("dR_R1.fq", "dR_R2.fq")]
    own = [p for p in pairs if "/" not in p[0]]
    assert reads.mates([f for f, _ in own], [r for _, r in reversed(own)]) == [("c", *own[0]), ("d", *own[1])]
    assert reads.mates(*map(list, zip(*pairs)), keep_order=True) == [("b", *pairs[0]), ("a", *pairs[1]), ("c", *pairs[2]), ("d", *pairs[3])]
    with pytest.raises(ValueError, match="duplicate"):
        reads.sample_names(["a.fq", "y/a.fq.gz"])
    with pytest.raises(ValueError, match="duplicate"):
        reads.mates(["a_1.fq", "y/a_1.fq"], ["a_2.fq", "y/a_2.fq"])
    with pytest.raises(ValueError, match="as many"):
        reads.mates(["a_1.fq"], [])
    rows = [*pairs, ("x/a_1.fastq.gz", None), ("e.fq", None)]
    named = reads.named_files(frame(rows, "forward string, reverse string")).collect()
    assert {r["forward"]: r["sample"] for r in named} == {"x/b.1.fq": "b", "x/a_1.fq.gz": "a", "c_R1.fq": "c", "dR_R1.fq": "d", "x/a_1.fastq.gz": "a_1", "e.fq": "e"}
