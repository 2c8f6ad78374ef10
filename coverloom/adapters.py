"""The driver's star-schema tables seen as observations, sizes, query hits, genomes, reads and bins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Tables:
    """Views over the Parquet tables of one scale; all are lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def otu(self) -> DataFrame:
        part = self.raw("part").select("p_partkey", "p_brand", "p_type")
        rows = self.raw("lineitem").select("l_partkey", "l_suppkey", "l_quantity").join(part, F.col("l_partkey") == F.col("p_partkey"))
        key = {"gene": F.col("p_brand"), "sample": F.concat(F.lit("S"), "l_suppkey"), "sequence": F.concat(F.lit("P"), "l_partkey"), "taxonomy": F.concat(F.lit("Root; d__"), "p_type")}
        out = rows.groupBy(*[c.alias(n) for n, c in key.items()]).agg(F.count(F.lit(1)).alias("num_hits"), F.sum("l_quantity").alias("coverage"))
        return out.select("gene", "sample", "sequence", "num_hits", "coverage", "taxonomy")

    def number(self, column: str = "sequence"):
        """The key behind the letter of a sequence or sample name."""
        return F.substring(column, 2, 20).try_cast("bigint")

    def read_size(self) -> DataFrame:
        rows = self.raw("lineitem").groupBy("l_suppkey").agg((F.sum("l_linenumber") * 1000).cast("bigint").alias("read_size"))
        return rows.select(F.concat(F.lit("S"), "l_suppkey").alias("sample"), "read_size")

    def query_hits(self) -> DataFrame:
        """Even part keys hit a genome, every sixth key two."""
        otu = self.otu().withColumn("p", self.number()).where("p % 2 = 0")
        genomes = F.when(F.col("p") % 6 == 0, F.array(F.col("p") % 7, F.col("p") % 7 + 7)).otherwise(F.array(F.col("p") % 7))
        return otu.select(
            F.col("sample").alias("query_name"), F.col("sequence").alias("query_sequence"), (F.col("p") % 13).alias("divergence"), "num_hits", "coverage",
            F.explode(F.transform(genomes, lambda g: F.concat(F.lit("G"), g.cast("string")))).alias("sample"), F.col("gene").alias("marker"), F.col("sequence").alias("hit_sequence"), "taxonomy",
        )

    def binned(self) -> DataFrame:
        """Observations whose part key divides by 3 are known, from one genome or, for multiples of 6, two."""
        otu = self.otu().withColumn("p", self.number()).where("p % 3 = 0")
        found = F.when(F.col("p") % 6 == 0, F.concat(F.lit("G"), F.col("p") % 5, F.lit("_protein,G"), F.col("p") % 5 + 5, F.lit("_protein"))).otherwise(F.concat(F.lit("G"), F.col("p") % 5, F.lit("_protein")))
        return otu.withColumn("found_in", found).drop("p")

    def unbinned(self) -> DataFrame:
        return self.otu().withColumn("p", self.number()).where("p % 3 <> 0").drop("p").withColumn("found_in", F.lit(None).cast("string"))

    def recovered(self) -> DataFrame:
        """Sequences of recovered genomes of two coassemblies, some of them in no sample."""
        seq = self.otu().select("gene", "sequence", "taxonomy").distinct().withColumn("p", self.number()).where("p % 4 = 0")
        name = F.concat(F.lit("coassembly_"), (F.col("p") % 7).cast("string"), F.lit("-genome_"), (F.col("p") % 3).cast("string"))
        unseen = F.when(F.col("p") % 20 == 0, F.concat("sequence", F.lit("x"))).otherwise(F.col("sequence"))
        return seq.select("gene", name.alias("sample"), unseen.alias("sequence"), F.lit(1).cast("bigint").alias("num_hits"), F.lit(1.0).alias("coverage"), "taxonomy")

    def groups(self) -> DataFrame:
        """Clusters of two neighbouring suppliers each: (coassembly, samples)."""
        s = self.raw("supplier").select(((F.col("s_suppkey") - 1) / 2).cast("bigint").alias("i"), F.concat(F.lit("S"), "s_suppkey").alias("s"))
        return s.groupBy("i").agg(F.array_join(F.array_sort(F.collect_list("s")), ",").alias("samples")).select(F.concat(F.lit("coassembly_"), "i").alias("coassembly"), "samples")

    def sequence_sets(self) -> DataFrame:
        """Each sample's sequences in the shape of a sketch: (sample, kmer)."""
        return self.otu().select("sample", F.col("sequence").alias("kmer")).distinct()

    def reads(self) -> DataFrame:
        """Read headers of conversations: (sample, read, number)."""
        from pyspark.sql import Window as W

        w = W.partitionBy("sample").orderBy("conv_id", "turn")
        rows = self.raw("conversations").select(F.concat(F.lit("C"), F.floor(F.col("conv_id") / 8).cast("string")).alias("sample"), "conv_id", "turn", "role")
        return rows.select("sample", F.concat("role", F.lit(" "), (F.col("conv_id") / 2).cast("bigint").cast("string")).alias("read"), F.row_number().over(w).cast("bigint").alias("number"))

    def fastq(self) -> DataFrame:
        """The same reads as lines of read files: (sample, number, i, value)."""
        four = F.array(F.concat(F.lit("@"), "read"), F.concat(F.lit("ACGT"), "number"), F.lit("+"), F.lit("!!!!"))
        return self.reads().select("sample", "number", F.posexplode(four).alias("i", "value"))

    def genome_files(self) -> DataFrame:
        """Parts as contigs of genomes' files, one for each size: (bin, i, p_partkey, value)."""
        two = F.array(F.concat(F.lit(">"), "p_name"), F.concat("p_brand", F.lit(">"), "p_type"))
        return self.raw("part").select(F.concat(F.lit("B"), "p_size").alias("bin"), "p_partkey", F.posexplode(two).alias("i", "value"))

    def some_hits(self) -> DataFrame:
        """query_hits where every seventh sample hit nothing."""
        return self.query_hits().where(self.number("query_name") % 7 != 0)

    def fine(self) -> DataFrame:
        """unbinned with sequences told apart by a part's place and state in its order, so that many are in one sample alone."""
        rows = self.raw("lineitem").groupBy("l_suppkey", "l_partkey", "l_returnflag", "l_linestatus", "l_linenumber").agg(F.count(F.lit(1)).alias("num_hits"), F.sum("l_quantity").alias("coverage"))
        name = F.concat(F.lit("P"), "l_partkey", F.lit("."), "l_returnflag", "l_linestatus", "l_linenumber")
        return rows.select(F.lit("g").alias("gene"), F.concat(F.lit("S"), "l_suppkey").alias("sample"), name.alias("sequence"), "num_hits", "coverage", F.lit("Root").alias("taxonomy"))

    def lines(self) -> DataFrame:
        """Lines of documents as of read files: (sample, line_no, value)."""
        each = self.raw("documents").select(F.concat(F.lit("D"), "doc_id").alias("sample"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("i", "value"))
        return each.select("sample", (F.col("i") + 1).alias("line_no"), "value")

    def bins(self) -> DataFrame:
        s = self.raw("supplier")
        cents = F.abs(F.round(F.col("s_acctbal") * 100)).cast("bigint")
        return s.select(F.concat(F.lit("bin_"), "s_suppkey").alias("Name"), (cents % 101).cast("string").alias("Completeness"), F.when(F.col("s_suppkey") % 17 == 0, F.lit("n/a")).otherwise((cents % 23).cast("string")).alias("Contamination"))


#: The same views in DuckDB SQL, as common table expressions.
SQL = {
    "otu": "SELECT p_brand AS gene, 'S' || l_suppkey AS sample, 'P' || l_partkey AS sequence, count(*)::BIGINT AS num_hits, sum(l_quantity) AS coverage, 'Root; d__' || p_type AS taxonomy FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand, l_suppkey, l_partkey, p_type",
    "read_size": "SELECT 'S' || l_suppkey AS sample, (sum(l_linenumber) * 1000)::BIGINT AS read_size FROM lineitem GROUP BY l_suppkey",
    "query_hits": "SELECT sample AS query_name, sequence AS query_sequence, p % 13 AS divergence, gene AS marker, 'G' || unnest(CASE WHEN p % 6 = 0 THEN [p % 7, p % 7 + 7] ELSE [p % 7] END) AS genome FROM (SELECT *, substr(sequence, 2)::BIGINT AS p FROM otu) WHERE p % 2 = 0",
    "binned": "SELECT gene, sample, sequence, num_hits, coverage, taxonomy, CASE WHEN p % 6 = 0 THEN 'G' || (p % 5) || '_protein,G' || (p % 5 + 5) || '_protein' ELSE 'G' || (p % 5) || '_protein' END AS found_in FROM (SELECT *, substr(sequence, 2)::BIGINT AS p FROM otu) WHERE p % 3 = 0",
    "unbinned": "SELECT gene, sample, sequence, num_hits, coverage, taxonomy, NULL::VARCHAR AS found_in FROM (SELECT *, substr(sequence, 2)::BIGINT AS p FROM otu) WHERE p % 3 <> 0",
    "recovered": "SELECT gene, 'coassembly_' || (p % 7) AS coassembly, 'genome_' || (p % 3) AS genome, CASE WHEN p % 20 = 0 THEN sequence || 'x' ELSE sequence END AS sequence, taxonomy FROM (SELECT DISTINCT gene, sequence, taxonomy, substr(sequence, 2)::BIGINT AS p FROM otu) WHERE p % 4 = 0",
    "reads": "SELECT 'C' || (conv_id // 8) AS sample, role || ' ' || (conv_id // 2) AS read, row_number() OVER (PARTITION BY conv_id // 8 ORDER BY conv_id, turn) AS number FROM conversations",
    "lines": "SELECT sample, row_number() OVER (PARTITION BY sample ORDER BY i) AS line_no, value FROM (SELECT 'D' || doc_id AS sample, unnest(string_split(coalesce(text, ''), chr(10))) AS value, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)",
    "bins": "SELECT 'bin_' || s_suppkey AS Name, abs(round(s_acctbal * 100))::BIGINT % 101 AS comp, CASE WHEN s_suppkey % 17 <> 0 THEN abs(round(s_acctbal * 100))::BIGINT % 23 END AS cont FROM supplier",
    "some_hits": "SELECT * FROM query_hits WHERE substr(query_name, 2)::BIGINT % 7 <> 0",
    "fine": "SELECT 'S' || l_suppkey AS sample, 'P' || l_partkey || '.' || l_returnflag || l_linestatus || l_linenumber AS sequence, sum(l_quantity) AS coverage FROM lineitem GROUP BY ALL",
    # dense ids of the unbinned sequences
    "targets": "SELECT u.*, t.target FROM unbinned u JOIN (SELECT gene, sequence, row_number() OVER (ORDER BY gene, sequence) - 1 AS target FROM (SELECT DISTINCT gene, sequence FROM unbinned)) t USING (gene, sequence)",
    "pairs": "SELECT a.sample AS s1, b.sample AS s2, list_sort(list(a.target)) AS ids FROM targets a JOIN targets b ON a.target = b.target AND a.sample < b.sample WHERE a.coverage + b.coverage > 90 GROUP BY a.sample, b.sample",
    "pools": "SELECT n, samples, list_sort(list(target)) AS ids FROM (SELECT target, n, list_sort(list(sample)) AS samples FROM targets, (VALUES (3)) AS v(n) WHERE coverage > 90.0 / n GROUP BY target, n) WHERE len(samples) >= n GROUP BY n, samples",
    "groups": "SELECT 'coassembly_' || ((s_suppkey - 1) // 2) AS coassembly, string_agg('S' || s_suppkey, ',' ORDER BY 'S' || s_suppkey) AS samples FROM supplier GROUP BY (s_suppkey - 1) // 2",
    "distances": "SELECT x AS query_name, y AS match_name, c / (p.n + q.n - c) AS jaccard FROM (SELECT a.sample AS x, b.sample AS y, count(*) AS c FROM (SELECT DISTINCT sample, sequence FROM otu) a JOIN (SELECT DISTINCT sample, sequence FROM otu) b ON a.sequence = b.sequence AND a.sample < b.sample GROUP BY ALL) JOIN (SELECT sample, count(DISTINCT sequence) AS n FROM otu GROUP BY sample) p ON p.sample = x JOIN (SELECT sample, count(DISTINCT sequence) AS n FROM otu GROUP BY sample) q ON q.sample = y WHERE c / (p.n + q.n - c) >= 0.1",
}
#: What each view is made of.
_USES = {"query_hits": ["otu"], "some_hits": ["otu", "query_hits"], "binned": ["otu"], "unbinned": ["otu"], "recovered": ["otu"], "targets": ["otu", "unbinned"], "pairs": ["otu", "unbinned", "targets"], "pools": ["otu", "unbinned", "targets"], "distances": ["otu"]}


def with_views(body: str, *views: str, recursive: bool = False) -> str:
    """body behind WITH clauses for the views and what they need."""
    names: list[str] = []
    for v in views:
        names += [x for x in [*_USES.get(v, []), v] if x not in names]
    ctes = ", ".join(f"{n} AS MATERIALIZED ({SQL[n]})" for n in names)
    body = body.strip()
    more = body[:5].upper() == "WITH "
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}{', ' + body[5:] if more else ' ' + body}"
