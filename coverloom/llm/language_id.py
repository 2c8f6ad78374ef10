"""Language ID by a linear-chain conditional random field over the words of each line.

A word's features are its n-grams (of bytes, with marks at the word's edges), its affixes (the first and the last one to three
bytes), both hashed into one table of weights, and its entry in a lexicon: the words that the training texts have more than
once, LEXICON of them at most, each with weights of its own, and one entry for all other words.
Transitions between neighbouring words are learned with them, by stochastic gradients of the chain's log-likelihood, from
labelled texts and from lines that join two texts of different labels, so that a text may switch. Forward-backward gives
each word's label probabilities; neighbouring words with letters of one most probable label are a run. A document's label is
the one with the largest mean over all its words with letters, and its score is that mean: it needs the probabilities of all
labels, which runs don't have, so it is taken from the words. Chains restart at line ends, which bounds the length of most chains; a long line is still one chain.

The model is fitted on the driver on at most MAX_ROWS labelled texts: of each label the ones with the least hashes of their
ids, a tenth of the bound for all labels alike and the rest in proportion. So every label is learned; of more than MAX_ROWS
labels, only the most frequent ones. Of rows that share an id and a label the least text is taken; a text of over
MAX_BYTES / 16 isn't, nor are texts beyond MAX_BYTES together.

Defined cases: a null text, or one without a Unicode letter, gives "und" with score 0; ties go to the first label in order; a label
needs one training text; rows are judged alone, so repeated rows agree; extra columns are dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from coverloom.llm.kernels import U, column, hash_words, lower_table, mix, pieces, split_words, tidy, weights, white_words
from coverloom.llm.util import arrow_batches, bounded, ship

#: Bounds of the training sample, in texts and in bytes of text; a text of over a sixteenth of these bytes isn't sampled.
MAX_ROWS, MAX_BYTES = 2_000, 64 << 20
#: Hashed weights of each label, a power of two, and the most words that the lexicon has.
TABLE, LEXICON = 1 << 15, 1 << 16


def _letters() -> np.ndarray:
    table = np.zeros(256, bool)
    table[65:91] = table[97:123] = True
    return table


def lettered(d, first, last):
    """Which words d[first:last] have a Unicode letter. Only words of bytes from 128 up without an ASCII letter are decoded."""
    if not len(first):
        return np.zeros(0, bool)
    edges = np.stack((first, last), 1).reshape(-1)
    pad = np.append(d, 0)
    found = np.logical_or.reduceat(_letters()[pad], edges)[::2]
    for i in np.flatnonzero(np.logical_or.reduceat(pad > 127, edges)[::2] & ~found):
        found[i] = any(map(str.isalpha, d[first[i] : last[i]].tobytes().decode("utf-8", "ignore")))
    return found


GRAMS, AFFIXES = (2, 3, 4), (1, 2, 3)


def features(d, first, last):
    """(start, hashed n-grams, hashed affixes, hash of the word): n-grams have a row for each length and a place for each byte of the edged words, affixes a row for each length and side; TABLE where there is none; start is where each word begins in the n-grams. d: lower-cased bytes."""
    n = (last - first).astype(np.int64)
    size = n + 2  # an edge mark on either side
    start = np.concatenate(([0], np.cumsum(size)[:-1]))
    marked = np.full(int(size.sum()) + max(GRAMS), 1, np.uint64)
    at = np.arange(int(n.sum()))
    owner = np.repeat(np.arange(len(n)), n)
    marked[at + 2 * owner + 1] = d[at + (first - np.concatenate(([0], np.cumsum(n)[:-1])))[owner]] + U(2)
    left = np.repeat(start + size, size) - np.arange(int(size.sum()))  # bytes up to the word's end
    c = weights(8, 3)
    out = np.empty((len(GRAMS), len(left)), np.int32)
    for r, g in enumerate(GRAMS):
        h = marked[: len(left)] * c[0]
        for i in range(1, g):
            h += marked[i : len(left) + i] * c[i]
        out[r] = np.where(left >= g, (mix(h + U(g)) & U(TABLE - 1)).astype(np.int32), TABLE)
    affix = np.full((2 * len(AFFIXES), len(n)), TABLE, np.int32)
    for r, size in enumerate(AFFIXES):
        own = np.flatnonzero(n >= size)
        for side, begin in enumerate((first[own], last[own] - size)):
            h = sum((d[begin + i].astype(np.uint64) + U(2)) * c[i] for i in range(size))
            affix[2 * r + side, own] = (mix(h + U(100 + 10 * size + side)) & U(TABLE - 1)).astype(np.int32)
    return start, out, affix, hash_words(d, first, last, 5)


def counted(start, grams, affix, words):
    """Features of each word."""
    size = np.diff(np.append(start, grams.shape[1]))
    return 1 + (affix < TABLE).sum(0) + sum(np.maximum(size - g + 1, 0) for g in GRAMS)


def entries(words, lexicon):
    """Place of each word's hash in the sorted lexicon, its length for a word that it lacks."""
    at = np.minimum(np.searchsorted(lexicon, words), max(len(lexicon) - 1, 0))
    return np.where(lexicon[at] == words, at, len(lexicon)) if len(lexicon) else np.zeros(len(words), np.int64)


def lexicon_of(texts: list[bytes], most: int = LEXICON) -> np.ndarray:
    """Sorted hashes of the most frequent words that occur more than once, lower-cased."""
    data, starts, ends = _flat(texts)
    d = lower_table()[data]
    first, last, _ = split_words(d, starts, ends, white_words())
    h, n = np.unique(hash_words(d, first, last, 5), return_counts=True)
    h, n = h[n > 1], n[n > 1]
    return np.sort(h[np.lexsort((h, -n))[:most]])


def emissions(feats, table):
    """Scores (words, labels): sums of the features' weights over the square root of their number. table: hashed weights, the lexicon and its words' weights."""
    start, grams, affix, words = feats
    hashed = table["hashed"]
    if not len(start):
        return np.zeros((0, hashed.shape[1]), np.float32)
    wide = np.concatenate((hashed, np.zeros((1, hashed.shape[1]), hashed.dtype)))
    total = table["words"][entries(words, table["lexicon"])] + wide[affix].sum(0) + np.add.reduceat(wide[grams].sum(0), start, axis=0)
    return total / np.sqrt(counted(*feats))[:, None].astype(np.float32)


def chains(begin, length):
    """Order of the chains by falling length, and for each step the number of chains that reach it."""
    order = np.argsort(-length, kind="stable")
    n = length[order]
    steps = int(n[0]) if len(n) else 0
    alive = np.searchsorted(-n, -np.arange(1, steps + 1), "right")
    return begin[order], alive


def marginals(scores, begin, length, trans, pairs: bool = False):
    """Label probabilities of every word by forward-backward; chains are [begin, begin + length). pairs: also the expected transitions."""
    e = np.exp(scores - scores.max(1, keepdims=True))
    t = np.exp(trans)
    first, alive = chains(begin, length)
    fwd, bwd = np.empty_like(e), np.ones_like(e)
    prev = None
    for i, k in enumerate(alive):
        at = first[:k] + i
        a = e[at] if prev is None else (prev[:k] @ t) * e[at]
        a /= a.sum(1, keepdims=True)
        fwd[at] = prev = a
    for i in range(len(alive) - 1, 0, -1):
        at = first[: alive[i]] + i
        b = (e[at] * bwd[at]) @ t.T
        bwd[at - 1] = b / b.sum(1, keepdims=True)
    p = fwd * bwd
    p /= p.sum(1, keepdims=True)
    if not pairs:
        return p
    inner = np.ones(len(e), bool)
    inner[begin] = False
    at = np.flatnonzero(inner)
    x = fwd[at - 1][:, :, None] * t[None] * (e[at] * bwd[at])[:, None, :]
    return p, (x / x.sum((1, 2), keepdims=True)).sum(0), at


def _lines(d, first, row):
    """Chains of words: begin and length; a chain ends with a line or a row."""
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    line = np.cumsum(d == 10)[first]
    new = np.concatenate(([True], (line[1:] != line[:-1]) | (row[1:] != row[:-1])))
    begin = np.flatnonzero(new)
    return begin, np.diff(np.append(begin, len(first)))


def _flat(texts: list[bytes]):
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts]).astype(np.int64)
    return data, np.concatenate(([0], ends[:-1])), ends


def fit(texts: list[str], labels: list[str], epochs: int = 4, rate: float = 0.5, decay: float = 1e-6, step: int = 1 << 16, mixed: float = 0.1, seed: int = 7):
    """(labels, weights as emissions takes them, transitions), by Adagrad over texts in random order. mixed: share of texts that are joined line by line with another."""
    names = sorted(set(labels))
    code = {n: i for i, n in enumerate(names)}
    rng = np.random.default_rng(seed)
    raw = [t.encode() for t in texts]
    lexicon = lexicon_of(raw)
    hashed, known, trans = np.zeros((TABLE, len(names)), np.float32), np.zeros((len(lexicon) + 1, len(names)), np.float32), np.zeros((len(names), len(names)))
    g_hashed, g_known, g_trans = (np.full_like(x, 1e-3) for x in (hashed, known, trans))
    table = {"hashed": hashed, "lexicon": lexicon, "words": known}
    lower, words = lower_table(), white_words()
    y_of = np.array([code[x] for x in labels])
    steps = sum(map(len, raw)) // step + 1
    for _ in range(max(epochs, -(-160 // steps) if raw else 0)):  # small samples are gone through more often
        order = list(rng.permutation(len(raw)))
        while order:
            part, size = [], 0
            while order and (not part or size < step):
                part.append(order.pop())
                size += len(raw[part[-1]])
            data, starts, ends = _flat([raw[i] for i in part])
            d = lower[data]
            first, last, row = split_words(d, starts, ends, words)
            if not len(first):
                continue
            y = y_of[np.array(part)][row]
            begin, length = _lines(d, first, row)
            # joined chains: the word after such a line is taken as the same chain's next
            join = rng.random(len(begin)) < mixed
            join[0] = False
            begin = begin[~join]
            length = np.diff(np.append(begin, len(first)))
            start, grams, affix, whole = feats = features(d, first, last)
            p, pairs, at = marginals(emissions(feats, table).astype(np.float64), begin, length, trans, True)
            p[np.arange(len(y)), y] -= 1
            p /= np.sqrt(counted(*feats))[:, None]
            owner = np.repeat(np.arange(len(y)), np.diff(np.append(start, grams.shape[1])))
            entry = entries(whole, lexicon)
            for c in range(len(names)):
                g = sum(np.bincount(line, p[owner, c], TABLE + 1) for line in grams) + sum(np.bincount(line, p[:, c], TABLE + 1) for line in affix)
                for weights_, squares, own in ((hashed, g_hashed, g[:TABLE]), (known, g_known, np.bincount(entry, p[:, c], len(lexicon) + 1))):
                    own = own / len(y) + decay * weights_[:, c]
                    squares[:, c] += own * own
                    weights_[:, c] -= rate * own / np.sqrt(squares[:, c])
            np.subtract.at(pairs, (y[at - 1], y[at]), 1)
            pairs = pairs / max(1, len(at)) + 1e-4 * trans
            g_trans += pairs * pairs
            trans -= rate * pairs / np.sqrt(g_trans)
    return names, table, trans


def runs_of(p, own, row, n: int):
    """Words of one most probable label in a row, as (runs of each of the n rows, first word, end word, label, mean probability); words that aren't own neither end a run nor count in it."""
    w = np.flatnonzero(own)
    label = p[w].argmax(1)
    r = row[w]
    at = np.flatnonzero(np.concatenate(([True], (r[1:] != r[:-1]) | (label[1:] != label[:-1])))[: len(w)])
    if not len(at):
        return np.zeros(n, np.int64), at, at, at, np.zeros(0)
    place = w - np.searchsorted(row, r)
    size = np.diff(np.append(at, len(w)))
    chance = np.add.reduceat(p[w, label].astype(np.float64), at) / size
    return np.bincount(r[at], minlength=n), place[at], place[at + size - 1] + 1, label[at], chance


def _judge(model, kept_text: bool = False, spans: bool = True):
    def run(batches):
        names, table, trans = model.value
        lower, words = lower_table(), white_words()
        k = len(names)
        for b in batches:
            data, starts, ends, _ = column(b, "text")
            mean, sure = np.zeros((b.num_rows, max(k, 1))), np.zeros(b.num_rows)
            count, found = np.zeros(b.num_rows, np.int64), []
            for i, j in pieces(starts, ends, 1 << 20):
                a = starts[i]
                d = lower[data[a : ends[j - 1]]]
                first, last, row = split_words(d, starts[i:j] - a, ends[i:j] - a, words)
                if not len(first) or not k:
                    continue
                begin, length = _lines(d, first, row)
                _, some, which = np.unique(hash_words(d, first, last, 9), return_index=True, return_inverse=True)
                scores = emissions(features(d, first[some], last[some]), table)[which]
                p = marginals(scores, begin, length, trans.astype(np.float32))
                own = lettered(d, first[some], last[some])[which]
                n = np.bincount(row[own], minlength=j - i)
                for c in range(k):
                    mean[i:j, c] = np.bincount(row[own], p[own, c], j - i) / np.maximum(n, 1)
                sure[i:j] = np.bincount(row[own], p[own].max(1), j - i) / np.maximum(n, 1)
                if spans:
                    count[i:j], *part = runs_of(p, own, row, j - i)
                    found.append(part)
            best = mean.argmax(1)
            score = mean[np.arange(len(best)), best]
            none = score == 0
            pred = np.where(none, "und", np.array(names or ["und"], object)[best])
            out = {"doc_id": b.column("doc_id"), "lang_pred": pa.array(list(pred), pa.string()), "score": pa.array(np.clip(score, 0, 1)), "confidence": pa.array(np.clip(sure, 0, 1))}
            if spans:
                begin, end, label, chance = (np.concatenate(x) for x in zip(*found)) if found else np.zeros((4, 0))
                label = pa.array(np.array(names or ["und"], object)[label.astype(np.int64)], pa.string())
                fields = [pa.array(begin.astype(np.int32)), pa.array(end.astype(np.int32)), label, pa.array(np.clip(chance, 0, 1))]
                offsets = pa.array(np.concatenate(([0], np.cumsum(count))).astype(np.int32))
                out["runs"] = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, ["start", "end", "label", "probability"]))
            rest = b.schema.names[2 - kept_text :]
            yield pa.RecordBatch.from_arrays([*out.values(), *map(b.column, rest)], [*out, *rest])

    return tidy(run)


def quota(counts: list[int], most: int) -> int:
    """The largest q of which sum(min(n, q)) over counts is at most `most`."""
    q, left = 0, most
    for i, n in enumerate(sorted(counts)):
        q = left // (len(counts) - i)
        if n > q:
            return q
        left -= n
    return max(counts, default=q)


def allotted(counts: list[int], most: int) -> list[int]:
    """Texts to take of each label, `most` together at most: a tenth is for all labels alike, one text at least, the rest is in proportion to their texts."""
    q = max(1, quota(counts, most // 10))
    least = [min(n, q) for n in counts]
    rest, over = most - sum(least), max(1, sum(counts) - sum(least))
    return [m + min(n - m, rest * (n - m) // over) for n, m in zip(counts, least)]


def sample(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", max_rows: int = MAX_ROWS) -> DataFrame:
    """(i, l, k) of the labelled rows with the least hashes of their ids in each label, as many of each as allotted gives; k: their place in the label. Rows that share an id and a label count as one."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("i"), F.col(lang).alias("l"), F.xxhash64(F.col(doc_id).cast("string")).alias("h")).distinct()
    counts = rows.groupBy("l").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "l").limit(max_rows).collect()
    take = allotted([r["n"] for r in counts], max_rows)
    shares = docs.sparkSession.createDataFrame([(r["l"], q) for r, q in zip(counts, take)], T.StructType([rows.schema["l"], T.StructField("q", T.LongType())]))
    # each task keeps max_rows rows of a label at most before they meet
    rows = rows.withColumn("k", F.row_number().over(W.partitionBy("l").orderBy("h", "i"))).where(F.col("k") <= max_rows)
    rows = rows.join(F.broadcast(shares), "l").where(F.col("k") <= F.col("q"))
    return rows.select("i", "l", "k")


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES):
    """The model of the labelled rows of docs; at most max_rows texts of max_bytes bytes together reach the driver."""
    rows = sample(docs, doc_id, text, lang, max_rows)
    texts = docs.select(F.col(doc_id).alias("i"), F.col(text).cast("string").alias("t"), F.col(lang).alias("l")).where(F.octet_length("t") <= max_bytes // 16)
    one = texts.join(bounded(rows, max_rows), ["i", "l"]).groupBy("i", "l").agg(F.min("t").alias("t"), F.min("k").alias("k"))  # rows may share an id
    size = F.sum(F.octet_length("t").cast("long")).over(W.orderBy("k", "l", "i"))  # over max_rows rows at most
    got = one.withColumn("size", size).where(F.col("size") <= max_bytes).select("i", "l", "t").toArrow()
    order = np.argsort([str(x) for x in got.column("i").to_pylist()], kind="stable")
    t, y = got.column("t").to_pylist(), got.column("l").to_pylist()
    t, y = [t[i] for i in order], [y[i] for i in order]
    return fit(t, y)


def identify(docs: DataFrame, model, doc_id: str = "doc_id", text: str = "text", keep: list[str] | tuple[str, ...] = (), spans: bool = True) -> DataFrame:
    """doc_id, lang_pred, score, confidence, runs and the columns to keep for every row of docs; model: what train gave.

    confidence: mean over the words with letters of their largest probability, whichever label has it. runs (if spans): array
    of struct<start,end,label,probability>, the stretches of words of one label; start and end count words from 0.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    rest = [c for c in keep if c != "text"]
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), *rest)
    kept = own.select(*(["text"] if "text" in keep else []), *rest)
    runs = ", runs array<struct<start:int,end:int,label:string,probability:double>>" if spans else ""
    schema = T.StructType([*T.StructType.fromDDL(f"doc_id long, lang_pred string, score double, confidence double{runs}"), *kept.schema])
    return own.mapInArrow(_judge(shared, "text" in keep, spans), schema)


ship(__name__)
