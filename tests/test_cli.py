"""The command line, from files to files."""

import pytest

from coverloom import __main__ as main
from coverloom.cli import config
from coverloom.cli.arguments import ArgumentError, Given, params, parser, verify
from coverloom.cli.run import PLACES, _values, with_config
from coverloom.sources import files

OTU = "gene\tsample\tsequence\tnum_hits\tcoverage\ttaxonomy\n"
HITS = "query_name\tquery_sequence\tdivergence\tnum_hits\tcoverage\tsample\tmarker\thit_sequence\ttaxonomy\n"


@pytest.fixture()
def folder(tmp_path):
    """Four samples in two files: A1 and A2 share g1/AAA and g2/CCC, A3 and A4 share g1/GGG; TTT is known."""
    rows = [("g1", "A1", "AAA", 3, 6.0), ("g1", "A2", "AAA", 3, 6.0), ("g2", "A1", "CCC", 2, 8.0), ("g2", "A2", "CCC", 2, 8.0), ("g1", "A1", "TTT", 9, 40.0), ("g1", "A2", "TTT", 9, 40.0)]
    rows2 = [("g1", "A3", "GGG", 4, 7.0), ("g1", "A4", "GGG", 4, 7.0), ("g2", "A4", "CCC", 1, 2.0), ("g1", "A3", "TTT", 1, 30.0)]
    for name, part in (("one", rows), ("two", rows2)):
        (tmp_path / f"{name}.tsv").write_text(OTU + "".join("\t".join(map(str, (*r, "Root; d__B; p__X"))) + "\n" for r in part))
    known = [(s, "TTT", 1, 1, 1.0, "G1", "g1", "TTT", "Root") for s in ("A1", "A2", "A3")] + [("A4", "GGG", 50, 1, 1.0, "G1", "g1", "TTT", "Root")]
    (tmp_path / "hits.tsv").write_text(HITS + "".join("\t".join(map(str, r)) + "\n" for r in known))
    (tmp_path / "size.csv").write_text("A1,1000\nA2,2000\nA3,1500\nA4,500\n")
    return tmp_path


def run(*args):
    return main.main([str(x) for x in args])


def plan(folder, out, *more):
    return run("coassemble", "--sample-otu", folder / "one.tsv", folder / "two.tsv", "--sample-query", folder / "hits.tsv", "--genomes", "g.fna", "--sample-read-size", folder / "size.csv", "--output", out, *more)


def clusters(spark, out):
    return {r["samples"]: r for r in files.clusters(spark, f"{out}/coassemble/{PLACES['elusive_clusters']}").collect()}


def test_from_files_to_files(spark, folder):
    out = folder / "a"
    assert plan(folder, out) == 0
    got = clusters(spark, out)
    assert {k: (r["coassembly"], r["total_targets"], r["total_size"]) for k, r in got.items()} == {"A1,A2": ("coassembly_0", 2.0, 3000), "A3,A4": ("coassembly_1", 1.0, 2000)}
    assert files.appraised(spark, f"{out}/coassemble/{PLACES['binned']}").where("sequence = 'TTT' and found_in = 'G1'").count() == 3
    assert files.appraised(spark, f"{out}/coassemble/{PLACES['unbinned']}").count() == 7
    assert files.read_size(spark, f"{out}/coassemble/{PLACES['read_size']}").count() == 4
    text = [r["value"] for r in spark.read.text(f"{out}/coassemble/{PLACES['coassemble_commands']}").collect()]
    assert len(text) == 2 and text[0].startswith("aviary assemble --coassemble -1 A1 A2 ")
    again = config.parse((out / "config.yaml").read_text())
    assert again["min_sequence_coverage"] == 10 and again["command"] == "coassemble"

    # what the assemblies have recovered
    found = [("g1", "coassembly_0-genome_1", "AAA", 1, 1.0), ("g2", "coassembly_0-genome_1", "NEW", 1, 1.0), ("g1", "coassembly_1-genome_0", "GGG", 1, 1.0)]
    (folder / "rec.tsv").write_text(OTU + "".join("\t".join(map(str, (*r, "Root; d__B"))) + "\n" for r in found))
    assert run("evaluate", "--coassemble-output", out / "coassemble", "--recovered-otu", folder / "rec.tsv", "--output", folder / "b") == 0
    base = f"{folder}/b/evaluate/evaluate"
    stats = {(r[0], r[1]): (r[3], r[4]) for r in files.tsv(spark, f"{base}/summary_stats.tsv", "c string, s string, w string, m bigint, n bigint, t bigint, p double").collect()}
    assert stats["coassembly_0", "sequences"] == (1, 1) and stats["coassembly_1", "sequences"] == (1, 0) and stats["coassembly_0", "novel_sequences"] == (1, 1)
    assert spark.read.text(f"{base}/novel_hits.tsv").where("value like '%NEW%'").count() == 1

    # the plan again for one set
    (folder / "single").write_text("A3\n")
    assert run("update", "--coassemble-output", out / "coassemble", "--coassemblies", "coassembly_0", "--single-ended", folder / "single", "--output", folder / "c") == 0
    assert set(clusters(spark, folder / "c")) == {"A1,A2"}
    fetch = {r["value"] for r in spark.read.text(f"{folder}/c/coassemble/sra/recovery_samples.tsv").collect()}
    assert fetch == {"A1", "A2"}

    # the next plan: AAA is known now, and no set comes back
    (folder / "new.tsv").write_text(HITS + "".join(f"{s}\tAAA\t0\t1\t1.0\tN1\tg1\tAAA\tRoot\n" for s in ("A1", "A2")))
    assert run("iterate", "--coassemble-output", out / "coassemble", "--new-query", folder / "new.tsv", "--output", folder / "d") == 0
    left = files.appraised(spark, f"{folder}/d/coassemble/{PLACES['unbinned']}")
    assert left.where("sequence = 'AAA'").isEmpty() and left.count() == 5
    assert files.appraised(spark, f"{folder}/d/coassemble/{PLACES['binned']}").count() == 5
    assert not set(clusters(spark, folder / "d")) & set(got)


def test_single_and_genome_free_and_sizes_from_reads(spark, folder):
    for i in range(1, 5):
        for mate in (1, 2):
            (folder / f"A{i}_{mate}.fq").write_text("".join(f"@r{j}\n{'A' * (10 * i)}\n+\n{'!' * (10 * i)}\n" for j in range(3)))
    ways = [f"--{way}" for way in ("forward", "reverse")]
    lists = [str(folder / f"A{i}_{m}.fq") for m in (1, 2) for i in range(1, 5)]
    (folder / "rev").write_text("\n".join(lists[4:]) + "\n")
    (folder / "otus").mkdir()
    for n in ("one.tsv", "two.tsv"):
        (folder / n).rename(folder / "otus" / n)
    assert run("single", "--sample-otu-dir", folder / "otus", ways[0], *lists[:4], "--reverse-list", folder / "rev", "--output", folder / "s", "--min-sequence-coverage", 5, "--speed", "comprehensive") == 0
    got = clusters(spark, folder / "s")
    assert {k: (r["coassembly"], r["total_targets"], r["total_size"]) for k, r in got.items()} == {"A1": ("A1", 3.0, 60), "A2": ("A2", 3.0, 120), "A3": ("A3", 2.0, 180), "A4": ("A4", 1.0, 240)}
    text = [r["value"] for r in spark.read.text(f"{folder}/s/coassemble/{PLACES['recover_commands']}").collect()]
    assert len(text) == 4 and "--binning-only" not in text[0] and f"-1 {folder}/A1_1.fq" in text[0]


def test_values_of_an_earlier_configuration_hold(spark, folder):
    assert plan(folder, folder / "a", "--min-sequence-coverage", 15) == 0
    assert set(clusters(spark, folder / "a")) == {"A1,A2"}
    assert run("coassemble", "--config", folder / "a/config.yaml", "--output", folder / "b") == 0
    assert set(clusters(spark, folder / "b")) == {"A1,A2"}
    assert run("coassemble", "--config", folder / "a/config.yaml", "--output", folder / "c", "--min-sequence-coverage", 13) == 0
    assert set(clusters(spark, folder / "c")) == {"A1,A2", "A3,A4"}


def test_what_is_given_holds_over_a_configuration():
    earlier = {"min_sequence_coverage": 5, "max_coassembly_size": 20, "sample_otu": ["a", "b"], "speed": "comprehensive", "assemble_unmapped": True, "command": "single", "unknown": 1}
    args = ["coassemble", "--sample-read-size", "s", "--min-sequence-coverage", "10", "--max-coassembly-size", "None", "--sample-otu-list", "l"]
    a = with_config(parser().parse_args(args), vars(parser(Given).parse_args(args)), earlier)
    assert (a.min_sequence_coverage, a.max_coassembly_size, a.sample_otu, a.sample_otu_list) == (10.0, None, [], "l")
    assert (a.command, a.speed, a.assemble_unmapped, a.num_coassembly_samples) == ("coassemble", "comprehensive", True, 2) and not hasattr(a, "unknown")


def test_prior_assemblies_must_fit(folder):
    (folder / "prior.tsv").write_text("name\tassembly\nA1\tx.fna\nA9\ty.fna\n")
    args = ["single", "--sample-otu", folder / "one.tsv", "--sample-read-size", folder / "size.csv", "--prior-assemblies", folder / "prior.tsv", "--output", folder / "p"]
    with pytest.raises(ValueError, match="without an assembly"):
        run(*args)


PLAN = ["coassemble", "--sample-otu", "o", "--sample-read-size", "s"]
EARLIER = ["--coassemble-output", "x/coassemble", "--output", "y"]


@pytest.mark.parametrize(
    "args, says",
    [
        (["coassemble"], "observation tables"),
        ([*PLAN, "--sample-otu-list", "l"], "give one of"),
        (["coassemble", "--sample-otu", "o"], "reads, or their sizes"),
        (["coassemble", "--sample-otu", "o", "--forward", "f"], "interleaved"),
        ([*PLAN, "--reverse", "r"], "forward"),
        ([*PLAN, "--genomes", "g"], "query"),
        ([*PLAN, "--assemble-unmapped"], "reference genomes"),
        (["single", *PLAN[1:], "--assemble-unmapped", "--genomes", "g", "--sample-query", "q"], "unmapped"),
        (["single", *PLAN[1:], "--max-recovery-samples", "0"], "one at least"),
        ([*PLAN, "--max-coassembly-samples", "30"], "max-coassembly-samples"),
        ([*PLAN, "--num-coassembly-samples", "21"], "num-coassembly-samples"),
        ([*PLAN, "--prior-assemblies", "p"], "single-sample"),
        (["evaluate", "--recovered-otu", "r"], "earlier run"),
        (["evaluate", "--recovered-otu", "r", *EARLIER, "--new-genomes", "g"], "coassembly-run"),
        (["update"], "earlier run"),
        (["update", "--coassemble-output", "y/coassemble/", "--output", "y"], "overwrite"),
        (["iterate", *EARLIER], "new-query"),
        (["iterate", *EARLIER, "--new-query", "n", "--sample-query", "q", "--sample-otu", "o"], "earlier run's query"),
        (["iterate", *EARLIER, "--new-query", "n", "--sample-otu-dir", "d"], "folders"),
        (["iterate", *EARLIER, "--new-query", "n", "--single-assembly"], "not iterated"),
    ],
)
def test_arguments_that_don_t_fit(args, says):
    with pytest.raises(ArgumentError, match=says):
        verify(parser().parse_args(args))


def test_knobs_of_the_planner(spark, tmp_path):
    (tmp_path / "names").write_text("A1\nA2\n\n")
    a = verify(parser().parse_args([*PLAN, "--appraise-sequence-identity", "96", "--max-coassembly-size", "None", "--coassembly-samples-list", str(tmp_path / "names"), "--anchor-samples", "A1"]))
    p = params(a, _values(spark, a))
    assert (p.sequence_identity, p.max_size_gbp, p.coassembly_samples, p.anchor_samples) == (0.96, None, ("A1", "A2"), ("A1",))
    a = verify(parser().parse_args(["single", *PLAN[1:]]))
    assert params(a, {}).largest == 1 and params(a, {}).max_size is None
    with pytest.raises(SystemExit):
        parser().parse_args(["coassemble", "--kmer-precluster", "sometimes"])


def test_configuration(spark, tmp_path):
    own = {"a": 1, "b": ["x", "y: z"], "c": None, "d": {"k": [1.5]}, "e": "ä\n#", "f": False}
    back = config.parse(config.dump(own))
    assert back.pop("version") and back == {k: v for k, v in own.items() if v is not None}
    assert config.merged({"a": 1, "b": 2}, {"a": None, "b": 3}, {"c": 4}) == {"a": 1, "b": 3, "c": 4}
    yaml = pytest.importorskip("yaml")
    assert yaml.safe_load(config.dump(own))["d"] == {"k": [1.5]}
    assert config.parse("a: 1\nb:\n  - x\n  - y\n") == {"a": 1, "b": ["x", "y"]}
    assert run("build", "--output", tmp_path) == 0
    assert config.parse((tmp_path / "build/config.yaml").read_text())["num_samples"] == 2


def test_errors_of_arguments_end_the_program(capsys):
    assert run("update") == 2 and "earlier run" in capsys.readouterr().err
