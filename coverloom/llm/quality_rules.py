"""Quality rules: a threshold table compiled into one projection of length, symbol, stop-word and line ratios.

No user functions: every metric is a built-in expression over one row, so the filter needs no shuffle and no state.

Defined cases: a null or empty text has no words, so every count is 0 and the base rule fails it; a ratio over 0 words or
0 lines is 0; repeated rows are judged each alone; other columns of the input are kept out of the result unless asked for.
Five-word windows of one text are compared by 64-bit hashes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverloom.llm.util import let

# Frequent function words of the four languages. A text of prose has some of them.
STOP_WORDS = (
    "a an and are as at be by for from he in is it of on or re that the this to was with "
    "au aux dans de des du en est et il la le les ou par pas pour que qui sur un une "
    "al con como del el es las los mas no o para por se su y "
    "als auch auf das dem den der die ein eine für ist mit nicht sich und von zu im"
).split()


@dataclass(frozen=True)
class Rule:
    """A text passes if low <= metric <= high; texts of fewer than min_words words are not held to it."""

    metric: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0


#: The production table.
RULES = (
    Rule("mean_word_chars", 2.0, 14.0),
    Rule("symbols_per_word", high=0.25),
    Rule("shouts_per_word", high=0.5),
    Rule("stop_word_ratio", low=0.04, min_words=40),
    Rule("dup_line_ratio", high=0.3),
    Rule("ellipsis_line_ratio", high=0.3),
    Rule("bullet_line_ratio", high=0.9),
)


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def measured(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), shingle: int = 5) -> DataFrame:
    """The kept columns, the counts of the base rule and the metrics of the table."""
    white = " \t\n\x0b\x0c\r"
    raw = F.coalesce(F.col(text).cast("string"), F.lit(""))
    words = F.array_remove(F.split(F.translate(raw, white, " " * len(white)), " "), "")
    lines = F.filter(F.split(raw, "\n"), lambda x: F.length(F.translate(x, white, "")) > 0)

    def repeats(h: Column) -> Column:
        """Words in windows that occur twice or more; h: hashes of the words."""
        n = F.size(h) - (shingle - 1)
        grams = F.slice(F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, shingle)])), F.lit(1), F.greatest(n, F.lit(0)))

        def covered(g: Column) -> Column:
            order = F.array_sort(F.transform(g, lambda x, i: F.struct(x.alias("k"), i.alias("p"))))
            at = lambda z, i: F.get(z, i).getField("k")
            hit = let(order, lambda z: F.transform(F.filter(F.transform(z, lambda x, i: F.struct(x.getField("p").alias("p"), (F.coalesce(at(z, i - 1) == x.getField("k"), F.lit(False)) | F.coalesce(at(z, i + 1) == x.getField("k"), F.lit(False))).alias("hit"))), lambda y: y.getField("hit")), lambda y: y.getField("p")))
            runs = let(F.array_sort(hit), lambda p: F.aggregate(F.transform(p, lambda x, i: F.least(F.coalesce(F.get(p, i + 1) - x, F.lit(shingle)), F.lit(shingle)).cast("long")), F.lit(0).cast("long"), lambda a, b: a + b))
            return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long")).otherwise(runs)

        return let(grams, covered)

    def of_words(w: Column) -> Column:
        stop = F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS)))
        return F.struct(F.size(w).cast("long").alias("n_words"), let(F.transform(w, lambda x: F.xxhash64(x)), repeats).alias("n_repeat_words"), stop.cast("long").alias("n_stop_words"))

    def of_lines(x: Column) -> Column:
        ends = lambda s: F.rtrim(s)
        return F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            F.size(F.filter(x, lambda s: ends(s).endswith("...") | ends(s).endswith("…"))).cast("long").alias("n_ellipsis"),
            F.size(F.filter(x, lambda s: F.substring(F.ltrim(s), 1, 1).isin("-", "*", "•"))).cast("long").alias("n_bullets"),
        )

    one = docs.select(
        *keep,
        let(words, of_words).alias("_w"),
        let(lines, of_lines).alias("_l"),
        F.length(F.translate(raw, white, "")).cast("long").alias("word_chars"),
        _count(raw, "#*$%&|<>").cast("long").alias("n_symbols"),
        _count(raw, "!").cast("long").alias("n_shouts"),
    )
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    flat = one.select(*keep, "_w.n_words", "word_chars", "n_symbols", "_l.n_dup_lines", "_w.n_repeat_words", "_w.n_stop_words", "n_shouts", "_l.n_lines", "_l.n_ellipsis", "_l.n_bullets")
    return flat.select(
        "*",
        ratio("word_chars", "n_words").alias("mean_word_chars"),
        ratio("n_symbols", "n_words").alias("symbols_per_word"),
        ratio("n_shouts", "n_words").alias("shouts_per_word"),
        ratio("n_stop_words", "n_words").alias("stop_word_ratio"),
        ratio("n_dup_lines", "n_lines").alias("dup_line_ratio"),
        ratio("n_ellipsis", "n_lines").alias("ellipsis_line_ratio"),
        ratio("n_bullets", "n_lines").alias("bullet_line_ratio"),
    )


def compiled(rules: tuple[Rule, ...] = RULES) -> Column:
    """The names of the rules that a measured text fails, in the table's order, as one expression."""
    failed = []
    for r in rules:
        x = F.col(r.metric)
        bad = F.lit(False)
        if r.low is not None:
            bad = bad | (x < r.low)
        if r.high is not None:
            bad = bad | (x > r.high)
        failed.append(F.when(bad & (F.col("n_words") >= r.min_words), F.lit(r.metric)))
    return F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")


def judge(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), rules: tuple[Rule, ...] = RULES, min_words: int = 10, repeat_percent: int = 20) -> DataFrame:
    """Counts, failed rules (array of names), base_failed and kept for every row of docs."""
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    m = measured(docs, text, keep).withColumns({"base_failed": base, "failed_rules": compiled(rules)})
    return m.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
