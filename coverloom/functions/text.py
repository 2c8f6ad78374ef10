"""Column functions over names and comma lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sample_key(samples: Column) -> Column:
    """The sorted comma list of a sample set: its canonical key."""
    return F.array_join(F.array_sort(samples), ",")


def id_list(ids: Column) -> Column:
    """Comma list of ids sorted as strings."""
    return F.array_join(F.array_sort(F.transform(ids, lambda x: x.cast("string"))), ",")


def parts(text: Column) -> Column:
    return F.split(text, ",")


def strip_mate(name: Column) -> Column:
    """Without one trailing _1 or .1."""
    return F.regexp_replace(name, r"(_|\.)1$", "")


def strip_both(name: Column) -> Column:
    """Without a trailing _1, then without a trailing .1."""
    return F.regexp_replace(F.regexp_replace(name, r"_1$", ""), r"\.1$", "")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def reverse_complement(dna: Column) -> Column:
    return F.translate(F.reverse(dna), "ACGT", "TGCA")


def clean_sequence(seq: Column) -> Column:
    """Gaps and unknown bases as A."""
    return F.translate(seq, "-N", "AA")
