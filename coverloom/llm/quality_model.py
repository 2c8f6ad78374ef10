"""Quality classifier: Bradley-Terry ranking of documents from preferred pairs.

A document's strength is a linear score of features of its whole text; the chance that one document is preferred to another
is the logistic function of the difference of their strengths. Pairs of a good and a bad labelled text give the logistic
loss on feature differences, which Newton steps minimise with a ridge. The strength at the quantile that the bad texts make
up in the training sample is the threshold; the score is a logistic curve through 0.3 there, so score >= 0.3 and strength
at or above the threshold are the same.

The model is fitted on the driver on the features, not the texts, of at most MAX_ROWS labelled texts, the ones with the
least hashes of their ids, and on PAIRS random pairs of these.

Defined cases: null and empty texts have all counts 0 and get the score that this gives; a sample without both labels
ranks nothing, and every text has the score 0.3; a text with several labels is taken with each; of texts that share an id the
least is sampled; rows are judged alone; extra columns are dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverloom.llm.kernels import U, byte_set, column, grams, hash_words, lower_table, mix, pieces, split_words, tidy, white_words
from coverloom.llm.util import arrow_batches, bounded, ship

MAX_ROWS, PAIRS, CUT = 20_000, 200_000, 0.3
NAMES = (
    "log_words", "word_bytes", "symbols_per_word", "shouts_per_word", "bars_per_word", "upper_ratio", "digit_ratio", "dup_line_ratio",
    "repeat_ratio", "distinct_ratio", "words_per_line", "sentence_ends_per_word", "non_letter_ratio",
)


def measure(batch) -> np.ndarray:
    """(rows, features) of the column text."""
    data, starts, ends, _ = column(batch, "text")
    lower, words, letter = lower_table(), white_words(), byte_set((65, 90), (97, 122), (128, 255))
    kinds = {"sym": byte_set(*[(ord(c), ord(c)) for c in "#*$%&<>"]), "shout": byte_set((33, 33)), "bar": byte_set((124, 124)), "upper": byte_set((65, 90)), "digit": byte_set((48, 57)), "end": byte_set((46, 46), (63, 63)), "letter": letter}
    out = np.zeros((len(starts), len(NAMES)))
    for i, j in pieces(starts, ends):
        a, n = starts[i], j - i
        d = data[a : ends[j - 1]]
        s, e = starts[i:j] - a, ends[i:j] - a
        if not len(d):
            continue
        count = {}
        for name, table in kinds.items():
            c = np.concatenate(([0], np.cumsum(table[d])))
            count[name] = (c[e] - c[s]).astype(float)
        first, last, row = split_words(d, s, e, words)
        w = np.bincount(row, minlength=n).astype(float)
        h = hash_words(lower[d], first, last)
        salt = mix(np.arange(n, dtype=np.uint64) + U(99))
        _, at = np.unique(h ^ salt[row], return_index=True)
        distinct = np.bincount(row[at], minlength=n)
        repeat = np.zeros(n)
        if len(h) >= 5:
            g = grams(h, 5)
            ok = row[: len(g)] == row[4:]
            key, which, times = np.unique(g[ok] ^ salt[row[: len(g)][ok]], return_inverse=True, return_counts=True)
            hit = np.zeros(len(h) + 1, np.int64)
            twice = np.flatnonzero(ok)[times[which] > 1]
            np.add.at(hit, twice, 1)
            np.add.at(hit, twice + 5, -1)
            repeat = np.bincount(row[np.cumsum(hit[:-1]) > 0], minlength=n)
        lines, ends_, owner = split_words(d, s, e, ~byte_set((10, 10)))
        lh = hash_words(d, lines, ends_, 4)
        _, at = np.unique(lh ^ salt[owner], return_index=True)
        n_lines = np.bincount(owner, minlength=n).astype(float)
        dup = n_lines - np.bincount(owner[at], minlength=n)
        one, size = np.maximum(w, 1), np.maximum((e - s).astype(float), 1)
        c = count
        out[i:j] = np.stack([np.log1p(w), np.minimum((e - s) / one, 40), c["sym"] / one, c["shout"] / one, c["bar"] / one, c["upper"] / np.maximum(c["letter"], 1), c["digit"] / size, dup / np.maximum(n_lines, 1), repeat / one, distinct / one, np.log1p(w / np.maximum(n_lines, 1)), np.minimum(c["end"] / one, 1), 1 - c["letter"] / size], 1)
    return out


def fit(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, ridge: float = 1e-3, seed: int = 11):
    """(mean, scale, weights, threshold) from features and labels 0 or 1."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return np.zeros(x.shape[1]), np.ones(x.shape[1]), np.zeros(x.shape[1]), 0.0
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.clip((x - mean) / scale, -8, 8)
    rng = np.random.default_rng(seed)
    d = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        grad = d.T @ (p - 1) / pairs + ridge * w
        hess = (d * (p * (1 - p))[:, None]).T @ d / pairs + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    s = z @ w
    return mean, scale, w, float(np.quantile(s, len(bad) / len(y)))


def strength(x, model):
    mean, scale, w, cut = model
    return np.clip((x - mean) / scale, -8, 8) @ w - cut


def scores(x, model):
    """0 to 1; CUT at the threshold."""
    return 1 / (1 + np.exp(-np.clip(strength(x, model), -30, 30)) * (1 - CUT) / CUT)


def _measured(batches):
    for b in batches:
        m = measure(b)
        yield pa.RecordBatch.from_arrays([b.column("i"), b.column("y"), pa.FixedSizeListArray.from_arrays(pa.array(m.ravel()), m.shape[1]).cast(pa.list_(pa.float64()))], ["i", "y", "x"])


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = MAX_ROWS):
    """The model of the labelled documents; labels: doc_id and a label 0 or 1 (null: none)."""
    arrow_batches(docs.sparkSession)
    rows = labels.where(F.col(label).isNotNull()).select(F.col(doc_id).alias("i"), F.col(label).cast("int").alias("y"), F.xxhash64(F.col(doc_id).cast("string")).alias("h"))
    rows = rows.distinct().orderBy("h", "i", "y").limit(max_rows).select("i", "y")
    texts = docs.select(F.col(doc_id).alias("i"), F.col(text).cast("string").alias("text"))
    one = texts.join(bounded(rows, max_rows), "i").groupBy("i", "y").agg(F.min("text").alias("text"))  # rows may share an id
    got = one.mapInArrow(tidy(_measured), "i long, y int, x array<double>").toArrow().combine_chunks()
    if not got.num_rows:
        return fit(np.zeros((0, len(NAMES))), np.zeros(0))
    order = np.lexsort((got.column("y").to_numpy(), got.column("i").to_numpy()))
    x = np.asarray(got.column("x").combine_chunks().flatten()).reshape(-1, len(NAMES))
    return fit(x[order], got.column("y").to_numpy()[order])


def score(docs: DataFrame, model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score, predicted for every row of docs; model: what train gave."""
    arrow_batches(docs.sparkSession)

    def run(batches):
        for b in batches:
            x = scores(measure(b), model)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(x), pa.array((x >= CUT).astype(np.int32))], ["doc_id", "score", "predicted"])

    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return own.mapInArrow(tidy(run), "doc_id long, score double, predicted int")


ship(__name__)
