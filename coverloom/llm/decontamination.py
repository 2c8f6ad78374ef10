"""Benchmark decontamination over a distributed positional inverted index.

The benchmark's terms are counted over all texts first; the two that are rarest of a window's are the ones whose postings
(term, text, position) are stored. A window is looked up from its rarest term on: its list, and that of the second rarest, moved
by the distance that the window has between them, are intersected by blocks of a text, so that a posting meets only what stands
less than a window from it. What is looked up are pairs of terms and distances, not windows: a posting makes no more rows than
a window has places, however many windows share its term. The places that an intersection leaves are compared with the texts:
the words there are joined with the windows as a phrase, which gives exact matches with their items.

The same intersection without the distance gives the proximity matches: two rarest terms less than a window apart.

Defined cases: a null or empty text has no words and is clean; an item without words has no window; a window that several
items hold counts for each; repeated rows, also rows that share a doc id or have a null one, are each judged by their own
text (told apart by 64 bits of its hash); extra columns of either table are dropped. Broadcasts are counted first and
otherwise become shuffled joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from coverloom.llm.url_filter import maybe_in
from coverloom.llm.util import bounded, let, materialize

#: Rows of a benchmark-sized table (terms, windows) that may be broadcast.
BROADCAST_ROWS = 50_000
#: All ASCII but digits and letters.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BREAKS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())


def words(text: Column) -> Column:
    """Lower-cased words (A-Z only) of digits, letters and all beyond ASCII."""
    flat = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER + _BREAKS, _LOWER + " " * len(_BREAKS))
    return F.array_remove(F.split(flat, " "), "")


def windows(bench: DataFrame, item: str = "item_id", text: str = "text", size: int = 10) -> DataFrame:
    """Distinct windows: terms, items (distinct ids)."""
    w = bench.select(F.col(item).alias("item"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    each = w.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("terms"))
    return each.groupBy("terms").agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))


def build_index(docs: DataFrame, vocabulary: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text", limit: int = BROADCAST_ROWS) -> DataFrame:
    """Postings (term, doc, own, pos) of all words, or of those in vocabulary(term); own: a hash of the text, which tells texts of one doc id apart; pos counts from 0."""
    tokens = docs.select(F.col(doc_id).alias("doc"), _own(F.col(text)).alias("own"), F.posexplode(words(F.col(text))).alias("pos", "term"))
    return tokens if vocabulary is None else tokens.join(bounded(vocabulary, limit), "term").select(*[c for c in vocabulary.columns if c != "term"] or ["term"], "doc", "own", "pos")


def _own(text: Column) -> Column:
    return F.xxhash64(text.cast("string"))


def rarest(wins: DataFrame, df: DataFrame, lists: int = 2) -> DataFrame:
    """(window, t, off, k): the `lists` rarest terms of each window, with their offsets. wins: (window, ts: numbers of the terms in order); df: (t, df), how often the texts have a term."""
    terms = wins.select("window", F.posexplode("ts").alias("off", "t")).join(df, "t", "left").fillna(0, ["df"])
    ranked = terms.withColumn("k", F.row_number().over(W.partitionBy("window").orderBy("df", "off")))
    return ranked.where(F.col("k") <= lists).select("window", "t", "off", "k")


def proximity(postings: DataFrame, pairs: DataFrame, within: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """(doc, own, a, b, pos_a, pos_b) where the terms of a pair (a, b) stand at most `within` words apart. postings: (t, doc, own, pos). A text's positions are joined by blocks of `within` words, so that a posting meets 2 * within others at most, and then with the pairs."""
    block = F.floor(F.col("pos") / F.lit(within + 1))
    firsts = bounded(pairs.select(F.col("a").alias("t")).distinct(), limit)
    left = postings.join(firsts, "t", "left_semi").select("doc", "own", F.col("t").alias("a"), F.col("pos").alias("pos_a"), F.explode(F.array(block - 1, block, block + 1)).alias("block"))
    right = postings.select(F.col("doc").alias("_doc"), "own", F.col("t").alias("b"), F.col("pos").alias("pos_b"), block.alias("block"))
    met = left.alias("l").join(right.alias("r"), (F.col("l.own") == F.col("r.own")) & (F.col("l.block") == F.col("r.block")) & F.col("doc").eqNullSafe(F.col("_doc")))
    met = met.where((F.abs(F.col("pos_a") - F.col("pos_b")) <= within) & (F.col("pos_a") != F.col("pos_b")))
    return met.select("doc", "l.own", "a", "b", "pos_a", "pos_b").join(bounded(pairs.select("a", "b").distinct(), limit), ["a", "b"])


def phrase_candidates(postings: DataFrame, near: DataFrame, wins: DataFrame, ranked: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Distinct (doc, own, start, len) at which the two rarest terms of a window stand as in the window. near: what proximity gave for all pairs of them; a window of one term has all of the term's postings."""
    one, two = (ranked.where(F.col("k") == k).select("window", F.col("t").alias(t), F.col("off").alias(off)) for k, t, off in ((1, "a", "x"), (2, "b", "y")))
    both = one.join(two, "window").join(wins.select("window", F.size("terms").alias("len")), "window")
    asked = both.select("a", "b", (F.col("y") - F.col("x")).alias("apart"), "x", "len").distinct()
    met = near.withColumn("apart", F.col("pos_b") - F.col("pos_a")).join(bounded(asked, limit), ["a", "b", "apart"])
    found = met.where(F.col("pos_a") >= F.col("x")).select("doc", "own", (F.col("pos_a") - F.col("x")).alias("start"), "len")
    alone = one.join(wins.where(F.size("terms") == 1).select("window"), "window", "left_semi").select(F.col("a").alias("t")).distinct()
    single = postings.join(bounded(alone, limit), "t", "left_semi").select("doc", "own", F.col("pos").alias("start"), F.lit(1).alias("len"))
    return found.unionByName(single).distinct()


def _with(docs: DataFrame, by_text: DataFrame, columns: list[str], rest: bool) -> DataFrame:
    """docs (doc_id, _own, ...) with the columns of by_text (doc, own, ...). Only texts that may be there are shuffled; rest: whether the others are asked for, with nulls."""
    by_text = by_text.select(F.col("doc").alias("_doc"), F.col("own").alias("_o"), *columns)
    probed = maybe_in(docs, by_text, "_own", "_o", "_maybe")
    met = probed.where("_maybe").join(by_text, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_own") == F.col("_o")), "left" if rest else "inner").drop("_doc", "_o", "_maybe")
    if not rest:
        return met
    nulls = {c: F.lit(None).cast(by_text.schema[c].dataType) for c in columns}
    return met.unionByName(probed.where("not _maybe").drop("_maybe").withColumns(nulls))


def decontaminate(docs: DataFrame, bench: DataFrame, doc_id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", size: int = 10, limit: int = BROADCAST_ROWS, keep: tuple[str, ...] = (), near: bool = False) -> DataFrame:
    """For every row of docs: doc_id, the kept columns, n_words, hits (array of struct<start,len,items>), n_hit, items (sorted distinct ids as strings), contaminated; near: also n_near, how many pairs of a window's two rarest terms stand less than `size` words apart."""
    wins = materialize(windows(bench, item, item_text, size).withColumn("window", F.monotonically_increasing_id()), "windows")  # ids are fixed by writing them
    # numbers of terms are hashes: no numbering pass, and a clash only lets a candidate through to the exact comparison
    wins = wins.withColumn("ts", F.transform("terms", lambda x: F.xxhash64(x)))
    vocab = wins.select(F.explode("terms").alias("term")).distinct().withColumn("t", F.xxhash64("term"))
    df = build_index(docs, vocab, doc_id, text, limit).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    ranked = materialize(rarest(wins, df), "rarest")
    postings = materialize(build_index(docs, vocab.join(ranked, "t", "left_semi"), doc_id, text, limit).select("t", "doc", "own", "pos"), "postings")
    sides = [ranked.where(F.col("k") == k).select("window", F.col("t").alias(t)) for k, t in ((1, "a"), (2, "b"))]
    close = materialize(proximity(postings, sides[0].join(sides[1], "window"), size - 1, limit), "near")
    found = phrase_candidates(postings, close, wins, ranked, limit)
    asked = materialize(found.groupBy("doc", "own").agg(F.collect_list(F.struct("start", "len")).alias("_c")), "candidates")

    own = docs.select(F.col(doc_id).alias("doc_id"), *keep, F.col(text).alias("_text"), _own(F.col(text)).alias("_own"))
    at = _with(own.select("doc_id", "_text", "_own"), asked, ["_c"], False)
    phrase = lambda w, c: F.array_join(F.slice(w, c.getField("start") + 1, c.getField("len")), " ")
    there = let(words(F.col("_text")), lambda w: F.transform("_c", lambda c: F.struct(c.getField("start").alias("start"), c.getField("len").alias("len"), phrase(w, c).alias("phrase"))))
    there = at.select(F.col("doc_id").alias("doc"), F.col("_own").alias("own"), F.inline(there)).distinct()
    exact = there.join(bounded(wins.select(F.array_join("terms", " ").alias("phrase"), "items"), limit), "phrase")
    hits = materialize(exact.groupBy("doc", "own").agg(F.array_sort(F.collect_list(F.struct("start", "len", "items"))).alias("_hits")), "hits")

    judged = _with(own, hits, ["_hits"], True)
    none = F.array().cast(hits.schema["_hits"].dataType)
    judged = judged.select("doc_id", *keep, "_own", F.size(words(F.col("_text"))).cast("long").alias("n_words"), F.coalesce("_hits", none).alias("hits"))
    covered = F.flatten(F.transform("hits", lambda h: F.sequence(h.getField("start"), h.getField("start") + h.getField("len") - 1)))
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: h.getField("items")))))
    out = judged.withColumns({"n_hit": F.when(F.size("hits") > 0, F.size(F.array_distinct(covered))).otherwise(0).cast("long"), "items": items})
    out = out.withColumn("contaminated", F.col("n_hit") > 0)
    if near:
        counted = close.groupBy("doc", "own").agg(F.count_distinct("a", "b").alias("n_near"))
        out = _with(out, counted, ["n_near"], True).fillna(0, ["n_near"])
    return out.drop("_own")
