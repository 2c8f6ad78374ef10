"""The planner end to end: from observations to ranked sample sets, and the variants that replay or extend a plan."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverloom.operators import clusters, edges, precluster, report, targets
from coverloom.params import Params
from coverloom.scratch import cut


@dataclass(frozen=True)
class Plan:
    targets: DataFrame
    edges: DataFrame
    clusters: DataFrame
    unused: DataFrame


def plan(unbinned: DataFrame, binned: DataFrame, read_size: DataFrame, p: Params = Params(), samples: DataFrame | None = None, distances: DataFrame | None = None, weights: DataFrame | None = None) -> Plan:
    """All stages for one or several samples to an assembly, with or without preclusters and weights. distances: given ones; otherwise sketches are compared if the parameters ask for preclusters."""
    own = unbinned.drop("found_in")
    names = own.select("sample").distinct() if samples is None else samples.select("sample").distinct()
    single = p.largest == 1
    pre = distances is not None or p.preclusters(names.count() if p.kmer_precluster == "large" else 0)
    make = targets.hashed if pre else targets.dense
    # used by edges, weights and recovery: written once
    sought = cut(make(own, samples, p.taxa_of_interest), "targets")
    if pre:
        near = precluster.filtered(distances, p.jaccard_threshold) if distances is not None else precluster.jaccard(precluster.sketch(unbinned, p.kmer_length, p.taxa_of_interest), p.jaccard_threshold)
        sets = precluster.preclusters(near, p.neighbours, p.largest, list(p.anchor_samples), p.most_similar_first)
        found = edges.preclustered_single(sets, sought, names, p.min_sequence_coverage) if single else edges.preclustered(sets, sought, p.min_sequence_coverage)
    else:
        found = edges.single(sought, p.min_sequence_coverage) if single else edges.multi(sought, p.min_sequence_coverage, p.largest)
    found = cut(found, "edges")
    if weights is None and p.abundance_weighted:
        weights = targets.target_weights(sought, targets.abundance_weights(unbinned, binned, list(p.abundance_weighted_samples) or None))
    return Plan(sought, found, choose(found, read_size, p, weights), edges.unused_samples(names, found))


def choose(found: DataFrame, read_size: DataFrame, p: Params, weights: DataFrame | None = None) -> DataFrame:
    """Ranked clusters from edges."""
    single = p.largest == 1
    if weights is not None:
        weights = cut(weights, "weights")  # read twice
        if weights.isEmpty():
            found = found.where(F.lit(False))
    least = p.min_cluster_targets if p.min_cluster_targets is not None else clusters.min_targets(found)
    if single:
        usable, candidates = found, clusters.of_sources(found, list(p.coassembly_samples) or None)
    else:
        usable = clusters.restrict(found, list(p.coassembly_samples))
        candidates = clusters.matched(usable, p.num_samples, least)
        if p.largest > 2:
            candidates = candidates.unionByName(clusters.pooled(usable, p.num_samples, least, p.max_sample_combinations))
            # a set that is a match edge and a combination of a pool is one candidate
            candidates = candidates.groupBy("key", "samples").agg(F.flatten(F.collect_list("target_ids")).alias("target_ids"))
    candidates = clusters.anchored(clusters.exclude(candidates, list(p.exclude)), list(p.anchor_samples))
    ranked = cut(clusters.scored(clusters.sized(candidates, read_size, p.max_size), weights), "candidates")
    chosen = clusters.extra_targets(clusters.greedy(ranked), usable, p.max_sample_combinations)
    many = read_size.limit(clusters.LONG_LISTS + 1).count() > clusters.LONG_LISTS
    chosen = clusters.recovery(chosen, clusters.sample_targets(found, single), p.max_recovery_samples, many)
    return clusters.finished(chosen, p.max_recovery_samples, weights is not None, single)


def iterate(unbinned: DataFrame, binned: DataFrame, read_size: DataFrame, p: Params, earlier: list[str], last: DataFrame) -> tuple[Plan, DataFrame]:
    """The next plan, without sample sets of earlier ones, and its suggestions that the last plan had. At most one plan's sets reach the driver."""
    sets = [*earlier, *(r["samples"] for r in last.select("samples").distinct().collect())]
    new = plan(unbinned, binned, read_size, replace(p, exclude=tuple(dict.fromkeys([*p.exclude, *sets]))))
    return new, report.suggested_before(new.clusters, last)


def update(clusters_table: DataFrame, names: list[str], single_ended: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Chosen coassemblies of an earlier plan without single-ended samples, and the samples to fetch."""
    kept = report.drop_single_ended(report.subset(clusters_table, names) if names else clusters_table, list(single_ended))
    return kept, report.recovery_samples(kept)
