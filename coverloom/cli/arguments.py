"""Sub-commands, their arguments and the checks of what fits together."""

from __future__ import annotations

import argparse
import posixpath
import warnings

from coverloom.params import Params, as_fraction

#: Arguments that may be given as values, as a file of values, or as a folder of files, but in one way only.
WAYS = ("forward", "reverse", "genomes", "sample_otu", "sample_query", "coassembly_samples", "anchor_samples", "abundance_weighted_samples", "coassemblies", "exclude_coassemblies", "new_genomes")


class ArgumentError(ValueError):
    """Arguments that don't fit together."""


class Given(argparse.ArgumentParser):
    """Returns the arguments that are given alone, without the others' defaults."""

    def add_argument(self, *names, **kw):
        return super().add_argument(*names, **(kw | {"default": argparse.SUPPRESS}))


def _size(text: str) -> float | None:
    return None if text == "None" else float(text)


def _several(p: argparse.ArgumentParser, name: str, what: str, folder: bool = False) -> None:
    p.add_argument(f"--{name}", nargs="+", default=[], help=what)
    p.add_argument(f"--{name}-list", help=f"file with one a line: {what}")
    if folder:
        p.add_argument(f"--{name}-dir", help=f"folder of: {what}")


def _general(p: argparse.ArgumentParser) -> None:
    p.add_argument("--output", default="./", help="folder of the results")
    p.add_argument("--config", help="configuration of an earlier run, whose values hold where no argument is given")


def _inputs(p: argparse.ArgumentParser) -> None:
    _several(p, "forward", "forward reads")
    _several(p, "reverse", "reverse reads")
    _several(p, "genomes", "reference genomes")
    _several(p, "sample-otu", "observation tables of the samples", folder=True)
    _several(p, "sample-query", "hits of the samples' sequences in the reference genomes", folder=True)
    p.add_argument("--sample-read-size", help="sample,base pairs; else counted from the reads")
    _several(p, "coassembly-samples", "samples that may be assembled")
    _several(p, "anchor-samples", "samples of which every set has one")


def _planning(p: argparse.ArgumentParser) -> None:
    d = Params()
    p.add_argument("--taxa-of-interest", help="regular expression of taxonomies")
    p.add_argument("--appraise-sequence-identity", type=float, default=d.sequence_identity, help="identity from which on a sequence is known; over 1: percent")
    p.add_argument("--min-sequence-coverage", type=float, default=d.min_sequence_coverage)
    p.add_argument("--num-coassembly-samples", type=int, default=d.num_samples)
    p.add_argument("--max-coassembly-samples", type=int)
    p.add_argument("--max-coassembly-size", type=_size, default=d.max_size_gbp, help="gigabases, or None")
    p.add_argument("--max-recovery-samples", type=int, default=d.max_recovery_samples)
    p.add_argument("--max-sample-combinations", type=int, default=d.max_sample_combinations)
    _several(p, "exclude-coassemblies", "sample sets (comma lists) that were assembled before")
    p.add_argument("--abundance-weighted", action="store_true")
    _several(p, "abundance-weighted-samples", "samples whose abundances weigh")
    p.add_argument("--kmer-precluster", choices=("never", "large", "always"), default=d.kmer_precluster)
    p.add_argument("--precluster-size", type=int)
    p.add_argument("--precluster-distances", help="given distances of samples")
    p.add_argument("--single-assembly", action="store_true")
    p.add_argument("--prior-assemblies", help="name and assembly of samples that are assembled already")
    p.add_argument("--assemble-unmapped", action="store_true")
    p.add_argument("--unmapping-min-appraised", type=float, default=d.min_appraised)
    p.add_argument("--assemble-threads", type=int, default=64)
    p.add_argument("--assemble-memory", type=int, default=500)
    p.add_argument("--recover-threads", type=int, default=32)
    p.add_argument("--recover-memory", type=int, default=250)
    p.add_argument("--speed", choices=("fast", "comprehensive"), default="fast")


def _earlier(p: argparse.ArgumentParser) -> None:
    p.add_argument("--coassemble-output", help="folder of an earlier run's results")
    for name in ("unbinned", "binned", "targets", "elusive-edges", "elusive-clusters", "summary"):
        p.add_argument(f"--coassemble-{name}", help="this table of an earlier run, if not by its folder")


def parser(kind: type[argparse.ArgumentParser] = argparse.ArgumentParser) -> argparse.ArgumentParser:
    top = kind(prog="coverloom", description="Plan, evaluate and repeat the group assembly of samples.")
    sub = top.add_subparsers(dest="command", required=True)
    for name, what in (("coassemble", "sets of samples to assemble together"), ("single", "samples to assemble alone")):
        p = sub.add_parser(name, help=what)
        _general(p)
        _inputs(p)
        _planning(p)
    p = sub.add_parser("evaluate", help="what a plan's assemblies have recovered")
    _general(p)
    _earlier(p)
    p.add_argument("--recovered-otu", nargs="+", required=True, help="observation tables of the recovered genomes")
    p.add_argument("--recovered-bins", help="name and path of the recovered genomes; else those that have observations")
    _several(p, "new-genomes", "recovered genomes of another run")
    p.add_argument("--coassembly-run", help="name of the run that made them")
    p = sub.add_parser("update", help="an earlier plan again, for chosen sets")
    _general(p)
    _earlier(p)
    _inputs(p)
    _several(p, "coassemblies", "names of the sets to keep")
    p.add_argument("--single-ended", help="file with the samples that turned out to have one read of a pair only")
    for name, value in (("assemble-threads", 64), ("assemble-memory", 500), ("recover-threads", 32), ("recover-memory", 250)):
        p.add_argument(f"--{name}", type=int, default=value)
    p.add_argument("--speed", choices=("fast", "comprehensive"), default="fast")
    p = sub.add_parser("iterate", help="the next plan, with the genomes recovered since")
    _general(p)
    _earlier(p)
    _inputs(p)
    _planning(p)
    p.add_argument("--new-query", nargs="+", default=[], help="hits of the unbinned sequences in the new genomes")
    _several(p, "new-genomes", "new genomes")
    p.add_argument("--elusive-clusters", nargs="+", default=[], help="plans before the last one")
    p = sub.add_parser("build", help="check that the engine runs, and write the default configuration")
    _general(p)
    return top


def _one_way(a: argparse.Namespace) -> None:
    for name in WAYS:
        given = [w for w in (name, f"{name}_list", f"{name}_dir") if getattr(a, w, None)]
        if len(given) > 1:
            raise ArgumentError(f"give one of {', '.join('--' + g.replace('_', '-') for g in given)}")


def _any(a: argparse.Namespace, name: str) -> bool:
    return any(getattr(a, w, None) for w in (name, f"{name}_list", f"{name}_dir"))


def _planned(a: argparse.Namespace) -> None:
    if _any(a, "sample_query") and not _any(a, "sample_otu"):
        raise ArgumentError("query hits need the samples' observation tables (--sample-otu), which have the coverage")
    if _any(a, "genomes") and a.command != "iterate" and not _any(a, "sample_query"):
        raise ArgumentError("reference genomes need the hits of the samples' sequences in them (--sample-query)")
    if a.assemble_unmapped and a.single_assembly:
        raise ArgumentError("single-sample assembly takes whole samples, not unmapped reads")
    if a.assemble_unmapped and not _any(a, "genomes"):
        raise ArgumentError("unmapped reads need reference genomes")
    least, what = (1, "one") if a.single_assembly else (a.max_coassembly_samples, "--max-coassembly-samples") if a.max_coassembly_samples else (a.num_coassembly_samples, "--num-coassembly-samples")
    if a.max_recovery_samples < least:
        raise ArgumentError(f"--max-recovery-samples must be {what} at least")
    if a.prior_assemblies and not a.single_assembly:
        raise ArgumentError("prior assemblies are for single-sample assembly")


def _has_earlier(a: argparse.Namespace, summary: bool) -> None:
    parts = ["unbinned", "binned", "targets", "elusive_edges", "elusive_clusters", *["summary"] * summary]
    if not a.coassemble_output and not all(getattr(a, f"coassemble_{p}") for p in parts):
        raise ArgumentError("give the earlier run's folder (--coassemble-output) or all of its tables")
    if a.coassemble_output and posixpath.normpath(a.coassemble_output) == posixpath.normpath(posixpath.join(a.output, "coassemble")):
        raise ArgumentError("the results would overwrite the earlier run's")


def verify(a: argparse.Namespace) -> argparse.Namespace:
    """The arguments, with what a sub-command sets itself. Raises ArgumentError."""
    if a.command == "single":
        a.single_assembly = True
    _one_way(a)
    if a.command in ("coassemble", "single"):
        if not _any(a, "sample_otu"):
            raise ArgumentError("the samples' observation tables (--sample-otu) are needed")
        if _any(a, "reverse") and not _any(a, "forward"):
            raise ArgumentError("reverse reads need forward reads")
        if _any(a, "forward") and not _any(a, "reverse"):
            raise ArgumentError("interleaved and long reads aren't supported: give the reverse reads")
        if not _any(a, "forward") and not a.sample_read_size:
            raise ArgumentError("reads, or their sizes (--sample-read-size), are needed")
        _planned(a)
    elif a.command == "evaluate":
        _has_earlier(a, summary=True)
        if _any(a, "new_genomes") and not a.coassembly_run:
            raise ArgumentError("genomes of another run need its name (--coassembly-run)")
    elif a.command == "update":
        _has_earlier(a, summary=False)
        if not _any(a, "coassemblies"):
            warnings.warn("no --coassemblies given: all sets of the plan are kept", stacklevel=2)
    elif a.command == "iterate":
        if _any(a, "sample_query"):
            raise ArgumentError("an iteration takes the earlier run's query hits: give those in the new genomes (--new-query)")
        if a.sample_otu_dir:
            raise ArgumentError("an iteration takes no folders")
        if a.single_assembly:
            raise ArgumentError("single-sample plans are not iterated")
        _has_earlier(a, summary=False)
        if not a.new_query:
            raise ArgumentError("new genomes' hits (--new-query) are needed")
        _planned(a)
    return a


def params(a: argparse.Namespace, lists: dict[str, list[str]]) -> Params:
    """The planner's knobs; lists: the values of arguments that may stand in files."""
    p = Params(
        taxa_of_interest=a.taxa_of_interest or None, sequence_identity=as_fraction(a.appraise_sequence_identity), min_sequence_coverage=a.min_sequence_coverage,
        num_samples=a.num_coassembly_samples, max_samples=a.max_coassembly_samples, max_size_gbp=a.max_coassembly_size, max_recovery_samples=a.max_recovery_samples,
        max_sample_combinations=a.max_sample_combinations, exclude=tuple(lists.get("exclude_coassemblies", ())), coassembly_samples=tuple(lists.get("coassembly_samples", ())),
        anchor_samples=tuple(lists.get("anchor_samples", ())), abundance_weighted=a.abundance_weighted, abundance_weighted_samples=tuple(lists.get("abundance_weighted_samples", ())),
        kmer_precluster=a.kmer_precluster, precluster_size=a.precluster_size, min_appraised=a.unmapping_min_appraised,
    )
    return p.single() if a.single_assembly else p
