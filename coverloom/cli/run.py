"""The sub-commands from files to files. Tables are folders of tab-separated text under the names that other tools look for."""

from __future__ import annotations

import argparse
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coverloom import schemas
from coverloom.cli import config
from coverloom.cli.arguments import WAYS, params, verify
from coverloom.operators import appraise, edges, evaluate, genomes, reads, report
from coverloom.params import Params
from coverloom.plans import assemble
from coverloom.scratch import cut
from coverloom.sources import files

#: The places of a run's tables in its folder.
PLACES = {
    "unbinned": "appraise/unbinned.otu_table.tsv", "binned": "appraise/binned.otu_table.tsv", "targets": "target/targets.tsv", "elusive_edges": "target/elusive_edges.tsv",
    "elusive_clusters": "target/elusive_clusters.tsv", "unused": "target/unused_samples.tsv", "summary": "summary.tsv", "read_size": "read_size.csv",
    "coassemble_commands": "commands/coassemble_commands.sh", "recover_commands": "commands/recover_commands.sh",
}


def _values(spark: SparkSession, a: argparse.Namespace) -> dict[str, list[str]]:
    """The values of every argument that may stand in a file or folder."""
    out = {}
    for name in WAYS:
        own, listed, folder = (getattr(a, f"{name}{w}", None) for w in ("", "_list", "_dir"))
        out[name] = list(own or []) or (files.name_list(spark, listed) if listed else [f"{folder}/*"] if folder else [])
    return out


def _sizes(spark: SparkSession, a: argparse.Namespace, forward: list[str], reverse: list[str]) -> DataFrame:
    """Given sizes, else base pairs of both mates' files."""
    if a.sample_read_size:
        return files.read_size(spark, a.sample_read_size)
    pairs = reads.mates(forward, reverse)
    both = [reads.base_pairs(files.numbered_lines(spark, {name: f[i] for name, *f in pairs})) for i in (0, 1)]
    return both[0].unionByName(both[1]).groupBy("sample").agg(F.sum("read_size").alias("read_size"))


def _files(spark: SparkSession, forward: list[str], reverse: list[str]) -> DataFrame:
    return spark.createDataFrame([tuple(x) for x in reads.mates(forward, reverse)], "sample string, r1 string, r2 string")


def _save(spark: SparkSession, out: str, a: argparse.Namespace, clusters: DataFrame, files_of: DataFrame) -> None:
    """Summary and commands of the clusters."""
    files.write_tsv(report.coassembly_summary(clusters), f"{out}/{PLACES['summary']}", one_file=True)
    made = report.commands(clusters, files_of, out, a.assemble_threads, a.assemble_memory, a.recover_threads, a.recover_memory, a.speed == "fast")
    for name, column in (("coassemble_commands", "assemble"), ("recover_commands", "recover")):
        made.orderBy("coassembly").select(column).coalesce(1).write.mode("overwrite").text(f"{out}/{PLACES[name]}")


def _written(spark: SparkSession, out: str, plan: assemble.Plan) -> DataFrame:
    """The plan's tables; returns the clusters as written."""
    files.write_tsv(plan.targets.select(*[c.split()[0] for c in schemas.TARGETS.split(", ")]), f"{out}/{PLACES['targets']}")
    files.write_tsv(edges.to_text(plan.edges), f"{out}/{PLACES['elusive_edges']}")
    files.write_tsv(plan.clusters.select(*[c.split()[0] for c in schemas.CLUSTERS.split(", ")]), f"{out}/{PLACES['elusive_clusters']}", one_file=True)
    files.write_tsv(plan.unused, f"{out}/{PLACES['unused']}", header=False, one_file=True)
    return files.clusters(spark, f"{out}/{PLACES['elusive_clusters']}")


def _appraised(spark: SparkSession, out: str, binned: DataFrame, unbinned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables written, and read back."""
    for name, t in (("binned", binned), ("unbinned", unbinned)):
        files.write_tsv(t.select(*appraise.OTU, "found_in"), f"{out}/{PLACES[name]}")
    return files.appraised(spark, f"{out}/{PLACES['binned']}"), files.appraised(spark, f"{out}/{PLACES['unbinned']}")


def coassemble(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """coassemble and single. Returns the clusters."""
    v, out = _values(spark, a), f"{a.output.rstrip('/')}/coassemble"
    p = params(a, v)
    otu = appraise.rename_samples(files.otu_tables(spark, v["sample_otu"]))
    if v["sample_query"]:
        binned, unbinned = appraise.by_query_per_sample(files.query_hits(spark, v["sample_query"]), otu, p.sequence_identity, p.window_size)
    else:
        binned, unbinned = appraise.no_genomes(otu)
    binned, unbinned = _appraised(spark, out, binned, unbinned)
    size = cut(_sizes(spark, a, v["forward"], v["reverse"]), "sizes")
    files.write_tsv(size.select("sample", "read_size"), f"{out}/{PLACES['read_size']}", header=False, sep=",", one_file=True)
    if a.prior_assemblies:
        prior = files.tsv(spark, a.prior_assemblies, schemas.PRIOR_ASSEMBLIES)
        missing, extra = genomes.reconcile_assemblies(size.select("sample").distinct(), prior)
        for what, t in (("without an assembly", missing), ("of assemblies without reads", extra)):
            if names := [r["name"] for r in t.limit(5).collect()]:
                raise ValueError(f"samples {what}: {', '.join(names)}")
    distances = files.distances(spark, a.precluster_distances) if a.precluster_distances else None
    samples = size.select("sample").distinct()
    plan = assemble.plan(unbinned, binned, size, p, samples, distances)
    clusters = _written(spark, out, plan)
    if a.assemble_unmapped:
        files.write_tsv(genomes.reference_bins(binned, unbinned, p.min_appraised, p.trim_fraction), f"{out}/mapping/reference_bins.tsv")
    _save(spark, out, a, clusters, _files(spark, v["forward"], v["reverse"]))
    return clusters


def _place(a: argparse.Namespace, name: str) -> str:
    return getattr(a, f"coassemble_{name}", None) or f"{a.coassemble_output.rstrip('/')}/{PLACES[name]}"


def _targets(spark: SparkSession, path: str) -> DataFrame:
    return files.tsv(spark, path, schemas.TARGETS)


def run_evaluate(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """evaluate. Returns the statistics."""
    out = f"{a.output.rstrip('/')}/evaluate/evaluate"
    found = files.otu_tables(spark, a.recovered_otu)
    bins = files.tsv(spark, a.recovered_bins, schemas.RECOVERED_BINS) if a.recovered_bins else found.select(F.col("sample").alias("name")).distinct()
    e = files.tsv(spark, _place(a, "elusive_edges"), schemas.EDGES_TEXT)
    got = evaluate.evaluate(cut(_targets(spark, _place(a, "targets")), "targets"), files.appraised(spark, _place(a, "binned")), files.clusters(spark, _place(a, "elusive_clusters")), e, found, bins)
    stats = cut(got[2], "stats")
    for name, t in (("matched_hits", got[0]), ("novel_hits", got[1])):
        files.write_tsv(t, f"{out}/{name}.tsv")
    files.write_tsv(evaluate.ordered_summary(stats), f"{out}/summary_stats.tsv", one_file=True)
    files.write_tsv(evaluate.wide_table(stats, files.clusters(spark, _place(a, "elusive_clusters"))), f"{out}/summary_table.tsv", one_file=True)
    return stats


def run_update(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """update. Returns the clusters that are kept."""
    v, out = _values(spark, a), f"{a.output.rstrip('/')}/coassemble"
    single = files.name_list(spark, a.single_ended) if a.single_ended else []
    kept, fetch = assemble.update(files.clusters(spark, _place(a, "elusive_clusters")), v["coassemblies"], single)
    kept = cut(kept, "kept")
    files.write_tsv(kept, f"{out}/{PLACES['elusive_clusters']}", one_file=True)
    for name in ("targets", "elusive_edges"):
        spark.read.text(_place(a, name)).write.mode("overwrite").text(f"{out}/{PLACES[name]}")
    files.write_tsv(fetch, f"{out}/sra/recovery_samples.tsv", header=False, one_file=True)
    _save(spark, out, a, kept, _files(spark, v["forward"], v["reverse"]))
    return kept


def run_iterate(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """iterate. Returns the clusters."""
    v, out = _values(spark, a), f"{a.output.rstrip('/')}/coassemble"
    p = params(a, v)
    left, known = files.appraised(spark, _place(a, "unbinned")), files.appraised(spark, _place(a, "binned"))
    newly, unbinned = appraise.by_query_per_sample(files.query_hits(spark, a.new_query), left.drop("found_in"), p.sequence_identity, p.window_size)
    # a sample without new hits keeps what it had
    hit = files.query_hits(spark, a.new_query).select(F.col("query_name").alias("sample")).distinct()
    unbinned = unbinned.unionByName(left.join(hit, "sample", "left_anti").select(*unbinned.columns))
    binned, unbinned = _appraised(spark, out, appraise.update(known.select(*appraise.OTU, "found_in"), newly), unbinned)
    if v["forward"] or a.sample_read_size:
        size = _sizes(spark, a, v["forward"], v["reverse"])
    else:
        size = files.read_size(spark, f"{a.coassemble_output.rstrip('/')}/{PLACES['read_size']}")
    size = cut(size, "sizes")
    files.write_tsv(size.select("sample", "read_size"), f"{out}/{PLACES['read_size']}", header=False, sep=",", one_file=True)
    last = files.clusters(spark, _place(a, "elusive_clusters"))
    earlier = [r["samples"] for r in report.exclusions(*[files.clusters(spark, x) for x in a.elusive_clusters]).collect()] if a.elusive_clusters else []
    plan, again = assemble.iterate(unbinned, binned, size, p, earlier, last)
    clusters = _written(spark, out, plan)
    files.write_tsv(again, f"{out}/target/suggested_before.tsv", one_file=True)
    _save(spark, out, a, clusters, _files(spark, v["forward"], v["reverse"]))
    return clusters


def build(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """build: a job runs on the executors; the default configuration is written."""
    out = f"{a.output.rstrip('/')}/build"
    ready = cut(spark.range(1000).selectExpr("count(*) AS rows"), "ready")
    config.write(spark, config.dump(asdict(Params())), f"{out}/config.yaml")
    return ready


COMMANDS = {"coassemble": coassemble, "single": coassemble, "evaluate": run_evaluate, "update": run_update, "iterate": run_iterate, "build": build}


def run(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Check the arguments, write the configuration and run the sub-command."""
    verify(a)
    if a.command != "build":
        config.write(spark, config.dump(vars(a)), f"{a.output.rstrip('/')}/config.yaml")
    return COMMANDS[a.command](spark, a)


def with_config(a: argparse.Namespace, given: dict, earlier: dict) -> argparse.Namespace:
    """Arguments that are given, even as their default, over an earlier run's configuration over the defaults. A value given one way takes the place of the configuration's in any way."""
    anew = {f"{n}{w}" for n in WAYS for w in ("", "_list", "_dir") if any(f"{n}{x}" in given for x in ("", "_list", "_dir"))}
    known = {k: x for k, x in earlier.items() if k in vars(a) and k not in ("command", "config") and k not in anew}
    return argparse.Namespace(**(config.merged(vars(a), known) | given))

