"""The registered queries: each applies one operator to its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coverloom.llm import collocations, decontamination, language_id, license_scan, line_dedup, merkle, ngram_join, quality_model, quality_rules, sentence_pieces, sharding, suffix_dedup, url_filter
from coverloom.llm.util import scratch_path, table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quality_rules.judge(table(spark, sf_dir, "documents"))
    return q.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list: the URLs of pages whose id is divisible by 50."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    out = url_filter.judge(pages, pages.where(F.col("page_id") % 50 == 0))
    return out.select("page_id", "host", "path", "rule", "verdict")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), near=True)
    return d.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated", "n_near")


def _remainder(n: int):
    """Of the id's CRC; -1 for a null id, which is in no part."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % n, F.lit(-1))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.where(_remainder(3) != 1))
    out = language_id.identify(docs, model)
    return out.select("doc_id", (_remainder(3) == 1).alias("held_out"), "lang_pred", "score", "runs")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as it is read back after all of them have arrived and been compacted; live: its shard is in the manifest, with the bytes and rows that are read."""
    docs = table(spark, sf_dir, "documents")
    store = sharding.Store(spark, scratch_path(spark, "shards"))
    store.append(docs)
    version = store.compact(docs.schema)
    rows = store.read(docs.schema, version, with_file=True)
    shard = F.col(rows.columns[-1])
    rows = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("text_sha256"), shard["file"].alias("file"), shard["bytes"].alias("read"))
    files = store.manifest(version).join(rows.groupBy("file").agg(F.count(F.lit(1)).alias("found")), "file")
    files = files.select("file", "bytes", (F.col("rows") == F.col("found")).alias("whole"))
    live = F.coalesce(F.col("whole") & (F.col("read") == F.col("bytes")), F.lit(False))
    return rows.join(sharding.bounded(files, sharding.PLAN_ROWS), "file", "left").select("doc_id", "n_bytes", "text_sha256", live.alias("live"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan.scan(table(spark, sf_dir, "documents"))
    best = F.array_max(F.transform("matches", lambda m: m.getField("containment")))
    return out.select("doc_id", "n_words", F.array_join(F.transform("matches", lambda m: m.getField("license")), ",").alias("licenses"), F.size("matches").alias("n_licenses"), F.coalesce(best, F.lit(0.0)).alias("containment"), "matches")


def op8_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_model.train(docs, labels.where(_remainder(5) != 0))
    out = quality_model.score(docs, model)
    return out.select("doc_id", (_remainder(5) == 0).alias("held_out"), "score", "predicted")


def op9_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sentence_pieces.encode(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "lossless")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = suffix_dedup.dedup(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


#: The fields of a leaf, in their order.
LEAF = ["doc_id", "source", "lang", "n_chars", "text"]


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh document (by a hash of its id) is held against the manifest with one character more than it has."""
    docs = table(spark, sf_dir, "documents").select(*LEAF)
    changed = docs.n_chars + F.when(_remainder(7) == 0, 1).otherwise(0)
    claimed = merkle.digest(*[changed if c == "n_chars" else docs[c] for c in LEAF])
    proofs = merkle.prove(merkle.build(docs, LEAF, "lang", "doc_id", keep={"doc_id": docs.doc_id, "claimed": claimed}))
    folded = proofs.withColumns({"proof_sha256": merkle.proof_digest(F.col("proof")), "folded_root": merkle.fold(F.col("claimed"), F.col("proof"))})
    return folded.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    d = line_dedup.dedup(line_dedup.insert(None, docs), docs)
    return d.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents")).withColumnRenamed("grp", "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_ngram_join, op3_url_filter, op4_decontamination, op5_language_id, op6_sharding, op7_license_scan, op8_quality_model, op9_sentence_pieces, op10_suffix_dedup, op11_merkle_manifest, op12_line_dedup, op13_collocations)}
