"""Explicit schemas of every table; readers never infer."""

OTU = "gene string, sample string, sequence string, num_hits bigint, coverage double, taxonomy string"
APPRAISED = OTU + ", found_in string"
QUERY_HITS = "query_name string, query_sequence string, divergence bigint, num_hits bigint, coverage double, sample string, marker string, hit_sequence string, taxonomy string"
TARGETS = OTU + ", target bigint"
EDGES = "style string, cluster_size int, samples array<string>, target_ids array<bigint>"
EDGES_TEXT = "style string, cluster_size int, samples string, target_ids string"
DISTANCES = "query_name string, query_md5 string, match_name string, match_md5 string, containment double, max_containment double, jaccard double, intersect_hashes double"
READ_SIZE = "sample string, read_size bigint"
WEIGHTS = "gene string, sequence string, weight double"
TARGET_WEIGHTS = "target bigint, weight double"
CLUSTERS = "samples string, length int, total_targets double, total_size bigint, recover_samples string, coassembly string"
MATCHES = "coassembly string, gene string, sequence string, genome string, target string, found_in string, source_samples string, source_num_hits bigint, source_coverage double, taxonomy string"
SUMMARY = "coassembly string, statistic string, within string, match bigint, nonmatch bigint, total bigint, match_percent double"
RECOVERED_BINS = "name string, path string"
BIN_QUALITY = "Name string, Completeness string, Contamination string"
PRIOR_ASSEMBLIES = "name string, assembly string"
READ_HEADERS = "read string, number bigint"
LINES = "value string"


def empty(spark, ddl: str):
    """A table without rows."""
    return spark.range(0).selectExpr(*[f"cast(null as {kind}) as `{name}`" for name, kind in (c.strip().split(" ", 1) for c in _columns(ddl))])


def _columns(ddl: str) -> list[str]:
    """Columns of a schema text; commas inside <> don't part."""
    out, depth, word = [], 0, ""
    for c in ddl:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(word)
            word = ""
        else:
            word += c
    return [*out, word]
