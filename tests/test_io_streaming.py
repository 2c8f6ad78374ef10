import gzip

import pytest
from pyspark.sql import functions as F

from coverloom import schemas
from coverloom.operators import report
from coverloom.sources import files
from coverloom.streaming import ingest


def test_tables_as_text(spark, frame, tmp_path):
    t = frame([("g", "1", "ACGT", 2, 1.5, "Root; d__B")], schemas.OTU)
    files.write_tsv(t, str(tmp_path / "a"), one_file=True)
    back = files.otu_tables(spark, str(tmp_path / "a"))
    assert [tuple(r) for r in back.collect()] == [("g", "1", "ACGT", 2, 1.5, "Root; d__B")]
    assert back.schema["sample"].dataType.simpleString() == "string"


def test_many_files_each_with_a_header(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"t{i}.tsv").write_text("gene\tsample\tsequence\tnum_hits\tcoverage\ttaxonomy\ng\ts%d\tA\t1\t1.0\tR\n" % i)
    assert files.otu_tables(spark, f"{tmp_path}/*.tsv").count() == 3


def test_other_formats(spark, tmp_path):
    (tmp_path / "size.csv").write_text("1,10\n2,20\n")
    assert [tuple(r) for r in files.read_size(spark, str(tmp_path / "size.csv")).collect()] == [("1", 10), ("2", 20)]
    (tmp_path / "d.csv").write_text("query_name,query_md5,match_name,match_md5,containment,max_containment,jaccard,intersect_hashes\na,x,b,y,0,0,0.5,3\n")
    assert [tuple(r) for r in files.distances(spark, str(tmp_path / "d.csv")).collect()] == [("a", "b", 0.5)]
    (tmp_path / "list").write_text("a\n\nb\n")
    assert files.name_list(spark, str(tmp_path / "list")) == ["a", "b"]
    (tmp_path / "none").write_text("")
    with pytest.raises(ValueError):
        files.name_list(spark, str(tmp_path / "none"))
    with gzip.open(tmp_path / "r.fq.gz", "wt") as f:
        f.write("@a\nACGT\n+\n!!!!\n")
    lines = files.numbered_lines(spark, {"s": str(tmp_path / "r.fq.gz")})
    assert [(r["line_no"], r["value"]) for r in lines.orderBy("line_no").collect()][1] == (2, "ACGT")
    assert files.hashed_folder("ABCDEF") == "AB/CD/ABCDEF"


def test_lines_are_numbered_over_splits_and_files(spark, tmp_path):
    names = {"s 1": "a b.fq", "s+2": "c+d%20e.fq", "s3": "z.fq.gz", "s4": "empty.fq"}
    want = {"s 1": [f"line {i} {'x' * (i % 50)}" for i in range(3000)], "s+2": ["only"], "s3": [str(i) for i in range(500)], "s4": []}
    for k, f in names.items():
        text = "".join(x + "\n" for x in want[k]).encode()
        (tmp_path / f).write_bytes(gzip.compress(text) if f.endswith("gz") else text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        paths = {k: f"{tmp_path}/{f}" for k, f in names.items()}
        lines = files.numbered_lines(spark, paths)
        assert lines.rdd.getNumPartitions() > 10
        got = {k: [] for k in names}
        for r in lines.orderBy("sample", "line_no").collect():
            got[r["sample"]].append(r["value"])
            assert r["line_no"] == len(got[r["sample"]])
        assert got == want
        assert files.fasta(spark, paths).groupBy("bin").count().count() == 3
        assert "python" not in lines._jdf.queryExecution().toString().lower()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert files.numbered_lines(spark, {}).isEmpty() and files.fasta(spark, {}).isEmpty()
    with pytest.raises(ValueError):
        files.numbered_lines(spark, {"a": paths["s3"], "b": "file:" + paths["s3"]})


def test_stream_takes_each_file_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    head = "gene\tsample\tsequence\tnum_hits\tcoverage\ttaxonomy\n"
    for i in range(2):
        (tmp_path / f"in/{i}.tsv").write_text(head + f"g\ts\tq{i}\t1\t1.0\tR\n")
        ingest.to_parquet(ingest.arrivals(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(60)
        assert spark.read.parquet(str(tmp_path / "out")).count() == i + 1
    totals = ingest.gene_totals(spark.read.parquet(str(tmp_path / "out"))).first()
    assert (totals["num_hits"], totals["coverage"]) == (2, 2.0)


def test_empty_tables_have_their_columns(spark):
    assert schemas.empty(spark, schemas.EDGES).columns == ["style", "cluster_size", "samples", "target_ids"]


def test_completion_is_read_from_run_folders(spark, tmp_path):
    def put(run, name, text=""):
        f = tmp_path / run / "coassemble" / name
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text(text)

    header = "\t".join(c.split()[0] for c in schemas.CLUSTERS.split(", "))
    for run, names in (("a run+1", ["c0", "c1"]), ("b", ["c0"]), ("none", [])):
        put(run, "target/elusive_clusters.tsv", "\n".join([header, *(f"x,y\t2\t3.0\t4\tx,y\t{n}" for n in names)]) + "\n")
    put("a run+1", "coassemble/c0/assemble/assembly/final_contigs.fasta", ">x")
    put("a run+1", "coassemble/c0/recover/bins/bin_info.tsv")
    put("a run+1", "coassemble/c1/assemble/assembly/final_contigs.fasta/part-0", ">x")
    put("a run+1", "coassemble/other/recover/bins/bin_info.tsv")
    put("b", "coassemble/c0/assemble/assembly/final_contigs.fasta.gz")
    where = [str(tmp_path / r) for r in ("a run+1", "b", "none")]
    got = {(r["dir"], r["coassembly"]): (r["assembled"], r["recovered"]) for r in files.runs(spark, where).collect()}
    assert got == {(where[0], "c0"): (True, True), (where[0], "c1"): (True, False), (where[1], "c0"): (False, False)}
    total = {r["dir"]: (r["total"], r["assembled"], r["recovered"], r["incomplete"]) for r in report.completion(files.runs(spark, where)).collect()}
    assert total == {where[0]: (2, 2, 1, 1), where[1]: (1, 0, 0, 1), "2": (3, 2, 1, 2)}
    with pytest.raises(ValueError, match="twice"):
        files.runs(spark, [where[0], where[0] + "/"])


def test_tasks_make_and_find_results_of_runs(spark, tmp_path, monkeypatch):
    """No name of a coassembly reaches the driver, and what tasks find is what a listing finds."""
    root = str(tmp_path / "run 1")
    names = spark.createDataFrame([("c0",), ("c%2",), (".",), ("a/b",)], "coassembly string")
    rows = names.select(*[F.col(c) if c == "coassembly" else F.lit(None).cast("string").alias(c) for c in (x.split()[0] for x in schemas.CLUSTERS.split(", "))])
    files.write_tsv(rows, f"{root}/coassemble/target/elusive_clusters.tsv", one_file=True)
    assembled, recovered = files.RESULTS.values()
    made = [f"coassemble/coassemble/{x}" for x in (f"c0/{assembled}", f"c%2/{recovered}", f"a/b/{assembled}", assembled)]
    files.empty_files(spark.createDataFrame([(x,) for x in made], "name string"), root)
    own = files.clusters(spark, f"{root}/coassemble/target/elusive_clusters.tsv").select(F.lit(root).alias("dir"), "coassembly")
    listed = {(r["coassembly"], r["assembled"], r["recovered"]) for r in files._listed(spark, {root: own}).collect()}
    monkeypatch.setattr(files, "_listed", None)
    got = {(r["coassembly"], r["assembled"], r["recovered"]) for r in files.runs(spark, [root]).collect()}
    assert got == listed == {("c0", True, False), ("c%2", False, True), (".", False, False), ("a/b", False, False)}
