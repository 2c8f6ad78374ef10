"""The registered queries over the driver's tables: one or more for each dataflow, all over whole tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverloom import schemas, scratch
from coverloom.adapters import Tables
from coverloom.operators import appraise, clusters, edges, evaluate, genomes, precluster, reads, report, targets
from coverloom.params import Params
from coverloom.plans import assemble
from coverloom.sources import files

MIN_COVERAGE = 90
QUERIES = {}


def query(f):
    """Register f(tables) under its name."""
    QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
    return f


def _targets(t: Tables) -> DataFrame:
    return targets.dense(t.unbinned().drop("found_in"))


def _hashed(t: Tables) -> DataFrame:
    """Targets without a numbering pass, where ids don't show."""
    return targets.hashed(t.unbinned().drop("found_in"))


def _edge_text(e: DataFrame) -> DataFrame:
    return edges.to_text(e)


@query
def appraise_query_binned(t):
    return appraise.by_query(t.query_hits(), t.otu())[0]


@query
def appraise_query_unbinned(t):
    return appraise.by_query(t.query_hits(), t.otu())[1]


@query
def appraise_no_genomes(t):
    return appraise.no_genomes(t.otu(), "Brand#3")[1]


@query
def appraise_by_sample_binned(t):
    """A sample whose query is empty gives nothing, other samples are appraised."""
    return appraise.by_query_per_sample(t.some_hits(), t.otu())[0]


@query
def appraise_by_sample_unbinned(t):
    return appraise.by_query_per_sample(t.some_hits(), t.otu())[1]


@query
def appraise_combine(t):
    """Observations of new genomes behind those of earlier ones."""
    return appraise.combine(t.binned(), t.unbinned())


@query
def tables_as_text(t):
    """Observations written as tab-separated text, and read back from all files."""
    path = f"{scratch.folder(t.spark)}/otu"
    files.write_tsv(t.otu(), path)
    return files.otu_tables(t.spark, path)


@query
def appraise_update_union(t):
    newly = appraise.by_query(t.query_hits(), t.unbinned().drop("found_in"))[0]
    return appraise.update(t.binned(), newly)


@query
def bad_marker_filter(t):
    return appraise.drop_marker(t.otu(), "Brand#2")


@query
def sample_rename(t):
    return appraise.rename_samples(t.otu().withColumn("sample", F.concat(F.lit("runs/"), "gene", F.lit("/"), "sample"))).select("gene", "sample", "sequence")


@query
def targets_dense(t):
    return _targets(t).select("gene", "sample", "sequence", "num_hits", "coverage", "taxonomy", "target")


@query
def targets_in_file_order(t):
    """Ids by the first place of a sequence in the table, which here is in falling order of its key."""
    rows = t.unbinned().drop("found_in").withColumn("row", -t.number())
    return targets.dense(rows, row_index="row").groupBy("gene", "sequence", "target").agg(F.count(F.lit(1)).alias("n"))


@query
def targets_taxa_filter(t):
    return targets.chosen(t.otu(), taxa="d__ECONOMY|d__PROMO").groupBy("taxonomy").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("gene", "sequence").alias("n_targets"))


@query
def targets_hashed_groups(t):
    """Hashed ids tell the same sequences apart as dense ones."""
    return _hashed(t).groupBy("target").agg(F.min("gene").alias("gene"), F.min("sequence").alias("sequence"), F.countDistinct("gene", "sequence").alias("n_sequences"), F.count(F.lit(1)).alias("n_rows")).drop("target")


@query
def edges_match_pairs(t):
    return _edge_text(edges.pairs(_targets(t), MIN_COVERAGE))


@query
def edges_match_blocks(t):
    """Targets of over 20 rows by pairs of blocks of 8 rows."""
    return _edge_text(edges.pairs(_targets(t), MIN_COVERAGE, 20, 8))


@query
def edges_pool(t):
    return _edge_text(edges.pools(_targets(t), MIN_COVERAGE, 3))


@query
def edges_pool_sizes(t):
    """Pools of three and of four samples."""
    return _edge_text(edges.pools(_targets(t), MIN_COVERAGE, 4))


@query
def edges_single_directional(t):
    return _edge_text(edges.single(_targets(t), MIN_COVERAGE).where("style = 'directional'"))


@query
def edges_single_blocks(t):
    """Targets of over 20 rows by pairs of blocks of 8 rows."""
    return _edge_text(edges.single(_targets(t), MIN_COVERAGE, 20, 8).where("style = 'directional'"))


@query
def edges_single_singleton(t):
    """Over sequences that are told apart so finely that many are in one sample."""
    return _edge_text(edges.single(targets.dense(t.fine()), 10).where("style = 'singleton'"))


@query
def kmer_sketch(t):
    """Canonical 12-mers of a base-4 spelling of each sequence's key."""
    spelled = F.translate(F.lpad(F.conv(F.substring("sequence", 2, 20), 10, 4), 24, "0"), "0123", "ACGT")
    rows = t.otu().select("sample", "taxonomy", spelled.alias("sequence"))
    return precluster.sketch(rows, 12)


@query
def jaccard_pairs(t):
    return precluster.jaccard(t.sequence_sets(), 0.0)


@query
def jaccard_filter(t):
    return precluster.jaccard(t.sequence_sets(), 0.1)


@query
def precluster_topk(t):
    near, _ = precluster.neighbours(precluster.jaccard(t.sequence_sets()), 5, lower=False)
    return near.select("sample", F.array_join("nearest", ",").alias("nearest"))


@query
def precluster_combinations(t):
    return precluster.preclusters(precluster.jaccard(t.sequence_sets()), 4, 3).select(F.array_join("samples", ",").alias("samples"))


@query
def edges_preclustered_match(t):
    sets = precluster.preclusters(precluster.jaccard(t.sequence_sets()), 4, 3)
    return _edge_text(edges.preclustered(sets, _targets(t), MIN_COVERAGE))


@query
def edges_preclustered_single(t):
    sets = precluster.preclusters(precluster.jaccard(t.sequence_sets()), 4, 2)
    return _edge_text(edges.preclustered_single(sets, _targets(t), min_coverage=MIN_COVERAGE))


@query
def abundance_weighting(t):
    return targets.abundance_weights(t.unbinned(), t.binned()).withColumn("weight", F.round("weight", 9))


@query
def abundance_weighting_restricted(t):
    return targets.abundance_weights(t.unbinned(), t.binned(), ["S1", "S2", "S3", "S5", "S8"]).withColumn("weight", F.round("weight", 9))


@query
def target_weighting(t):
    w = targets.abundance_weights(t.unbinned(), t.binned())
    return targets.target_weights(_targets(t), w).withColumn("weight", F.round("weight", 9))


def _candidates(t: Tables) -> DataFrame:
    return clusters.matched(edges.pairs(_hashed(t), MIN_COVERAGE))


@query
def cluster_candidates_match(t):
    return _candidates(t).select(F.col("key").alias("samples"), F.size("target_ids").alias("n_targets"))


@query
def cluster_least_targets(t):
    """Of many edges only those with ten targets or more are candidates."""
    e = edges.pairs(_hashed(t), MIN_COVERAGE)
    return clusters.matched(e, 2, clusters.min_targets(e, 4000)).select(F.col("key").alias("samples"), F.size("target_ids").alias("n_targets"))


@query
def cluster_candidates_pool(t):
    got = clusters.pooled(edges.pools(_hashed(t), MIN_COVERAGE, 3))
    return got.select(F.col("key").alias("samples"), F.size("target_ids").alias("n_targets"))


@query
def cluster_candidates_pool_least(t):
    """Only sets of three targets or more; prefixes with fewer are given up early."""
    got = clusters.pooled(edges.pools(_hashed(t), MIN_COVERAGE, 3), min_targets=3)
    return got.select(F.col("key").alias("samples"), F.size("target_ids").alias("n_targets"))


@query
def cluster_candidates_single(t):
    return clusters.of_sources(edges.single(_hashed(t), MIN_COVERAGE)).select(F.col("key").alias("samples"), F.size("target_ids").alias("n_targets"))


@query
def cluster_restrict_samples(t):
    allowed = [f"S{i}" for i in range(1, 41)]
    e = clusters.restrict(edges.pools(_hashed(t), MIN_COVERAGE, 3), allowed)
    return e.select(F.array_join(F.array_sort("samples"), ",").alias("samples"), F.col("cluster_size").cast("int").alias("cluster_size"), F.size("target_ids").alias("n_targets"))


@query
def cluster_exclude(t):
    return clusters.exclude(_candidates(t), ["S2,S1", "S3,S4", "S9,S10"]).select(F.col("key").alias("samples"))


@query
def cluster_anchor(t):
    return clusters.anchored(_candidates(t), ["S7", "S11"]).select(F.col("key").alias("samples"))


@query
def cluster_size_score(t):
    return clusters.scored(clusters.sized(_candidates(t), t.read_size(), 9e6)).select(F.col("key").alias("samples"), "length", "total_targets", "total_size")


@query
def cluster_weighted_score(t):
    h = _hashed(t)
    w = targets.target_weights(h, targets.abundance_weights(t.unbinned(), t.binned()))
    got = clusters.scored(clusters.matched(edges.pairs(h, MIN_COVERAGE)), w)
    return got.select(F.col("key").alias("samples"), F.round("total_targets", 6).alias("total_targets"))


def _chosen(t: Tables) -> DataFrame:
    return clusters.greedy(scratch.cut(clusters.scored(clusters.sized(_candidates(t), t.read_size()))))


@query
def cluster_greedy(t):
    return _chosen(t).select(F.col("key").alias("samples"), "length", "total_targets", "total_size")


@query
def cluster_greedy_rounds(t):
    """The same choice in distributed rounds."""
    ranked = scratch.cut(clusters.scored(clusters.sized(_candidates(t), t.read_size())))
    return clusters.greedy(ranked, one_task=0).select(F.col("key").alias("samples"), "length", "total_targets", "total_size")


@query
def cluster_greedy_prefixes(t):
    """Rounds with prefixes of 500 candidates gone through in turn."""
    ranked = scratch.cut(clusters.scored(clusters.sized(_candidates(t), t.read_size())))
    return clusters.greedy(ranked, one_task=500).select(F.col("key").alias("samples"), "length", "total_targets", "total_size")


@query
def cluster_extra_targets(t):
    e = scratch.cut(edges.pools(_hashed(t), MIN_COVERAGE, 3))  # match edges take no part
    c = clusters.pooled(e, max_combined=9)
    return clusters.extra_targets(c.withColumn("length", F.size("samples")), e, 9).select(F.col("key").alias("samples"), F.size("target_ids").alias("n_targets"))


@query
def recover_candidates_topk(t):
    e = edges.pairs(_hashed(t), MIN_COVERAGE)
    got = clusters.recovery(clusters.matched(e), clusters.sample_targets(e), 6)
    return got.select(F.col("key").alias("samples"), F.array_join("recover_candidates", ",").alias("recover_candidates"))


#: The planner's knobs at the size of the driver's tables.
PLAN = Params(min_sequence_coverage=MIN_COVERAGE, max_size_gbp=None, max_recovery_samples=6, kmer_precluster="never", min_cluster_targets=1)


def _elusive(t: Tables) -> DataFrame:
    return assemble.plan(t.unbinned(), t.binned(), t.read_size(), PLAN).clusters


@query
def recover_candidates_bounded(t):
    """Long lists are read only for candidates that can still get a place."""
    e = edges.pairs(_hashed(t), MIN_COVERAGE)
    got = clusters.recovery(clusters.matched(e), clusters.sample_targets(e), 6, bounded=True)
    return got.select(F.col("key").alias("samples"), F.array_join("recover_candidates", ",").alias("recover_candidates"))


@query
def elusive_clusters(t):
    """Targets to ranked, disjoint sample pairs with their recovery samples, end to end."""
    return _elusive(t)


@query
def plan_single(t):
    """One sample to an assembly."""
    return assemble.plan(t.unbinned(), t.binned(), t.read_size(), PLAN.single()).clusters


@query
def plan_weighted(t):
    got = assemble.plan(t.unbinned(), t.binned(), t.read_size(), replace(PLAN, abundance_weighted=True)).clusters
    return got.withColumn("total_targets", F.round("total_targets", 6))


@query
def plan_given_distances(t):
    """Among the sets that given distances suggest."""
    near = precluster.jaccard(t.sequence_sets())
    return assemble.plan(t.unbinned(), t.binned(), t.read_size(), replace(PLAN, precluster_size=4), distances=near).clusters


@query
def plan_iterate(t):
    """The plan after a first one, whose sets are left out."""
    first = scratch.cut(_elusive(t), "first")
    return assemble.iterate(t.unbinned(), t.binned(), t.read_size(), PLAN, [], first)[0].clusters


@query
def plan_update(t):
    """Chosen coassemblies without single-ended samples."""
    kept, _ = assemble.update(_group_plan(t), ["coassembly_0", "coassembly_3", "coassembly_4"], ["S2", "S6"])
    return kept.select("coassembly", "samples", "total_size", "recover_samples")


def _group_plan(t: Tables) -> DataFrame:
    """The fixed clusters in the shape of a plan."""
    g = t.groups().withColumn("key", F.col("samples")).withColumn("samples", F.split("samples", ","))
    out = clusters.sized(g, t.read_size())
    return out.select("coassembly", F.col("key").alias("samples"), F.col("length").cast("int").alias("length"), F.lit(1.0).alias("total_targets"), "total_size", F.concat_ws(",", "key", F.lit("S1"), F.lit("S2")).alias("recover_samples"))


@query
def coassembly_summary(t):
    return report.coassembly_summary(_group_plan(t), t.read_size().withColumn("read_size", F.col("read_size") * 2))


@query
def cluster_length_histogram(t):
    return report.length_histogram(_group_plan(t))


@query
def unused_samples(t):
    return edges.unused_samples(t.otu().select("sample"), edges.pairs(_hashed(t), 200))


@query
def reference_bins_trimmed_mean(t):
    return genomes.reference_bins(t.binned(), t.unbinned())


def _hits(t: Tables) -> DataFrame:
    tg = scratch.cut(_targets(t))  # read by the edges and three times by the haystack
    return evaluate.combined(t.recovered(), evaluate.haystack(tg, t.binned(), t.groups(), edges.to_text(edges.pairs(tg, MIN_COVERAGE))))


@query
def evaluate_matched(t):
    return evaluate.matched(_hits(t))


@query
def evaluate_novel(t):
    return evaluate.novel(_hits(t)).select("coassembly", "gene", "sequence", "genome", "taxonomy")


@query
def evaluate_summary_stats(t):
    return evaluate.summary(_hits(t), t.recovered().select(F.col("sample").alias("name")).distinct())


@query
def evaluate_by_phylum(t):
    return evaluate.by_rank(evaluate.matched(_hits(t)), 1)


@query
def evaluate_wide_table(t):
    return evaluate.wide_table(evaluate.summary(_hits(t), t.recovered().select(F.col("sample").alias("name")).distinct()), _group_plan(t))


@query
def evaluate_by_gene(t):
    return evaluate.by_gene(evaluate.matched(_hits(t))).select("gene", "recovered", "missed")


@query
def command_rendering(t):
    files = t.otu().select("sample").distinct().select("sample", F.concat(F.lit("/r/"), "sample", F.lit("_1.fq")).alias("r1"), F.concat(F.lit("/r/"), "sample", F.lit("_2.fq")).alias("r2"))
    return report.commands(_group_plan(t), files, "out", fast=True)


@query
def interleave_pairs(t):
    r = t.reads()
    return reads.interleaved(r, r.groupBy("sample").agg(F.count(F.lit(1)).alias("n")))


def _read_lines(t: Tables) -> DataFrame:
    """The reads as text files, read back with their line numbers."""
    path = f"{scratch.folder(t.spark)}/reads"
    return files.numbered_lines(t.spark, files.write_lines(t.fastq(), path, "sample", "number", "i"))


@query
def read_file_names(t):
    """Names of samples from those of their read files, with and without mates."""
    kind = F.col("s_suppkey") % 4
    name = lambda m: F.concat(F.lit("/r/"), "s_name", F.when(kind == 0, f"_{m}.fq.gz").when(kind == 1, f".{m}.fastq").when(kind == 2, f"_R{m}.fna").otherwise(f"R_R{m}.txt"))
    return reads.named_files(t.raw("supplier").select(name(1).alias("forward"), F.when(F.col("s_suppkey") % 3 != 0, name(2)).alias("reverse")))


@query
def interleave_ends(t):
    """From text files: pairs among the first three and last two of each file."""
    own = reads.headers(_read_lines(t))
    n = own.groupBy("sample").agg(F.count(F.lit(1)).alias("n"))
    return reads.interleaved(reads.ends(own, 3, 2), n)


@query
def base_pairs_of_files(t):
    return reads.base_pairs(_read_lines(t))


@query
def deinterleave_mates(t):
    """Headers of the second mates' files."""
    return reads.headers(reads.renumbered(reads.deinterleave(_read_lines(t))[1]))


@query
def genome_fasta(t):
    """From text files: contigs under their genome's name."""
    path = f"{scratch.folder(t.spark)}/genomes"
    names = files.write_lines(t.genome_files(), path, "bin", "p_partkey", "i")
    return genomes.prefixed_fasta(files.fasta(t.spark, names))


@query
def base_pair_count(t):
    return reads.base_pairs(t.lines())


@query
def single_ended_filter(t):
    return report.drop_single_ended(_group_plan(t), ["S2", "S5"]).select("coassembly", "samples", "recover_samples")


@query
def recovery_samples(t):
    return report.recovery_samples(report.subset(_group_plan(t), ["coassembly_0", "coassembly_3", "coassembly_4"]))


@query
def duplicate_suggestions(t):
    old = t.groups().where(F.col("coassembly").rlike("[05]$"))
    return report.suggested_before(t.groups(), old)


@query
def exclusion_union(t):
    g = t.groups()
    return report.exclusions(g.where(F.col("coassembly").rlike("[0-4]$")), g.where(F.col("coassembly").rlike("[3-7]$")))


@query
def bin_quality_filter(t):
    return genomes.good_bins(t.bins()).select("Name")


@query
def bin_provenance(t):
    infos = t.raw("part").select(F.concat(F.lit("coassembly_"), (F.col("p_partkey") % 9).cast("string")).alias("coassembly"), (F.col("p_partkey") / 9).cast("bigint").alias("index"), F.concat(F.lower(F.substring("p_type", 1, 4)), F.lit("_bin."), "p_partkey").alias("Name"))
    return genomes.recovered_bins(infos, "out/coassemble", "out/recovered", iteration="2")


def _prior(t: Tables) -> DataFrame:
    return t.raw("customer").select(F.concat(F.lit("S"), F.col("c_custkey") * 3).alias("name"), F.concat(F.lit("/a/"), "c_name").alias("assembly"))


@query
def prior_assembly_missing(t):
    return genomes.reconcile_assemblies(t.otu().select("sample").distinct(), _prior(t))[0]


@query
def prior_assembly_extra(t):
    return genomes.reconcile_assemblies(t.otu().select("sample").distinct(), _prior(t))[1]


@query
def completion_report(t):
    o = t.raw("orders")
    done = o.select(F.col("o_orderpriority").alias("dir"), F.concat(F.lit("coassembly_"), "o_orderkey").alias("coassembly"), (F.col("o_orderstatus") != "O").alias("assembled"), (F.col("o_orderstatus") == "F").alias("recovered"))
    return report.completion(done)


@query
def completion_of_folders(t):
    """Run folders are written, one for each fifth of the nations with a coassembly for each supplier, and their completion is read from what is there."""
    root = scratch.folder(t.spark)
    runs = t.raw("supplier").select((F.col("s_nationkey") % 5).alias("run"), F.concat(F.lit("coassembly_"), "s_suppkey").alias("coassembly"), (F.col("s_acctbal") > 0).alias("assembled"), (F.col("s_acctbal") > 5000).alias("recovered"))
    places = [f"{root}/run{i}" for i in range(5)]
    columns = [c.split()[0] for c in schemas.CLUSTERS.split(", ")]
    for i, place in enumerate(places):
        own = runs.where(F.col("run") == i)
        rows = own.select(*[F.col(c) if c == "coassembly" else F.lit(None).cast("string").alias(c) for c in columns])
        files.write_tsv(rows, f"{place}/coassemble/target/elusive_clusters.tsv", one_file=True)
    # the results of an external program, as empty files
    made = [F.when(F.col(what), F.concat(F.lit("run"), "run", F.lit("/coassemble/coassemble/"), "coassembly", F.lit(f"/{name}"))) for what, name in files.RESULTS.items()]
    files.empty_files(runs.select(F.explode(F.array(*made)).alias("name")).where("name is not null"), root)
    return report.completion(files.runs(t.spark, places).withColumn("dir", F.regexp_extract("dir", "[^/]+$", 0)))


@query
def consecutive_uniq_count(t):
    """Runs of equal event types in the order of events."""
    from coverloom.functions.index import numbered

    e = t.raw("events").select("ts", "event_id", F.col("event_type").alias("representative"))
    return genomes.uniq_runs(numbered(e, "i", "ts", "event_id").select("i", "representative"))
