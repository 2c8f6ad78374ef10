"""Every operator over tables with nulls in any column, empty and very long texts, ties, repeated rows, no rows, and extra columns of its own names."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from coverloom.llm import decontamination, language_id, license_scan, ngram_join, quality_model, quality_rules, sentence_pieces, sharding, suffix_dedup, url_filter
from tests.llm import brute

EXTRA = "k1, k, c, e, n, id, doc, pos, rep, root, node, size, part, rows, file, bytes, kept, spans, score, runs, items, hits, matches, word, term, window, start, block, bits, _doc, _maybe, _c, _text, _r, _in, _key"


@pytest.fixture(scope="module")
def hard(spark, prose):
    """Rows of doc_id, text and columns of names that operators use themselves."""
    long = prose(20_000, 1) + " " + "y" * 5000
    texts = [(1, "Alpha beta gamma delta epsilon zeta. " * 4), (1, "Alpha beta gamma delta epsilon zeta. " * 4), (2, None), (None, prose(30, 2)), (None, None), (3, ""), (4, " \n\t\r "), (5, long), (6, long), (7, "one"), (8, "\n\n- - |\n- - |"), (9, prose(30, 3)), (10, prose(30, 3) + " end")]
    names = [c.strip() for c in EXTRA.split(",")]
    rows = [(i, t, *([None] * len(names) if x % 3 == 0 else [f"v{x}"] * len(names))) for x, (i, t) in enumerate(texts)]
    d = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names)).repartition(3)
    return texts, d.cache()


def test_quality_rules(hard):
    texts, d = hard
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in quality_rules.judge(d).collect())
    assert got == Counter((i, *brute.quality(t)) for i, t in texts)
    assert quality_rules.judge(d.where("false")).isEmpty()


def test_ngram_join(hard):
    texts, d = hard
    rows = ngram_join.join(d).collect()
    assert Counter((r["doc_id"], r["n_shingles"]) for r in rows) == Counter((i, len(brute.shingles(t))) for i, t in texts)
    of = {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] is not None}
    assert of == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5, 7: 7, 8: 8, 9: 9, 10: 9}
    assert all(r["component_id"] is None for r in rows if r["doc_id"] is None)


def test_url_filter(spark):
    urls = ["http://A.net/es/x", "http://A.net/es/x", None, "", "no url", "://", "https://example.com/en/" + "p" * 100_000, "https://www.example.com/en/", "http://x.org/a?utm_x=1", "http://x.org/a/"]
    rows = [(i if i else None, u, f"v{i}", None) for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, canon string, block string").repartition(3)
    got = Counter((r["page_id"], r["host"], r["rule"], r["verdict"]) for r in url_filter.judge(pages, pages.where("page_id in (2, 3, 8)")).collect())
    want = [(None, "a.net", "net/es/", "block"), (1, "a.net", "net/es/", "block"), *[(i, "", None, "allow") for i in (2, 3, 4, 5)], (6, "example.com", "example.com/en/", "block"), (7, "www.example.com", "www.example.com/en/", "allow"), (8, "x.org", None, "block"), (9, "x.org", None, "block")]
    assert got == Counter(want)
    none = pages.where("false")
    assert url_filter.judge(none, pages).isEmpty() and url_filter.judge(pages, none).where("verdict = 'block' and rule is null").isEmpty()
    again = url_filter.judge(pages.union(pages), pages.where("page_id = 8"))
    assert again.count() == 2 * len(urls) and again.where("rule is null and verdict = 'block'").count() == 4


def test_decontamination(spark, hard):
    texts, d = hard
    items = [(1, "zeta alpha beta gamma delta epsilon zeta alpha beta gamma"), (1, "one"), (2, None), (3, ""), (None, "nothing here"), (4, "yyyy " * 3)]
    bench = spark.createDataFrame([(*i, "v", None) for i in items], "item_id long, text string, window string, ts string")
    got = Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in decontamination.decontaminate(d, bench).collect())
    want = Counter((i, *brute.contamination([(0, t)], [(i, t) for i, t in items if i is not None])[0][:2], tuple(brute.contamination([(0, t)], [(i, t) for i, t in items if i is not None])[0][2])) for i, t in texts)
    assert got == want and sum(n for (_, _, hit, _), n in got.items() if hit) >= 3
    assert decontamination.decontaminate(d.where("false"), bench).isEmpty()
    assert decontamination.decontaminate(d, bench.where("false")).where("contaminated").isEmpty()


def test_language_id(spark, hard, prose):
    texts, d = hard
    back = lambda n, seed: "".join(reversed(prose(n, seed)))
    model = language_id.fit([prose(30, i) for i in range(40)] + [back(30, i) for i in range(40)], ["x"] * 40 + ["y"] * 40)
    rows = language_id.identify(d, model).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in texts)
    of = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows if r["doc_id"] is not None}
    assert [of[i] for i in (2, 3, 4, 8)] == [("und", 0.0)] * 4 and of[5] == of[6] and of[9][0] == "x"
    assert len({(r["lang_pred"], r["score"]) for r in rows if r["doc_id"] == 1}) == 1
    even = language_id.fit([], [])
    assert {r["lang_pred"] for r in language_id.identify(d, even).collect()} == {"und"}
    # equal scores: the first label in order
    flat = (["a", "b"], {"hashed": np.zeros((language_id.TABLE, 2), np.float32), "lexicon": np.zeros(0, np.uint64), "words": np.zeros((1, 2), np.float32)}, np.zeros((2, 2)))
    assert {(r["lang_pred"], r["score"]) for r in language_id.identify(d.where("doc_id in (5, 9)"), flat).collect()} == {("a", 0.5)}


def test_sharding(hard, spark, tmp_path):
    texts, d = hard
    store = sharding.Store(spark, f"file://{tmp_path}/s")
    for _ in range(2):
        store.append(d, small_bytes=20_000, target=1 << 20)
    store.compact(d.schema, target=1 << 20)
    back = store.read(d.schema)
    assert back.exceptAll(d.union(d)).isEmpty() and back.count() == 2 * len(texts)


def test_license_scan(spark, hard, prose):
    texts, d = hard
    got = Counter((r["doc_id"], r["n_words"], len(r["matches"])) for r in license_scan.scan(d).collect())
    assert got == Counter((i, len(re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())), 0) for i, t in texts)
    mit = license_scan.TEMPLATES[3][1]
    rows = [(1, mit), (1, mit), (None, f"{prose(20_000, 4)} {mit}"), (2, f"{mit} {prose(50, 5)} {mit}"), (3, mit + " " + license_scan.TEMPLATES[4][1])]
    out = license_scan.scan(spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, matches int").repartition(2)).collect()
    n = len(re.findall(r"[a-z0-9]+", mit.lower()))
    assert sorted((r["doc_id"] or 0, m["license"], round(m["containment"], 3), m["first"], m["end"]) for r in out for m in r["matches"]) == sorted(
        [(0, "MIT", 1.0, 20_000, 20_000 + n), (1, "MIT", 1.0, 0, n), (1, "MIT", 1.0, 0, n), (2, "MIT", 1.0, 0, n), (3, "Apache-2.0", 1.0, n, n + 8), (3, "MIT", 1.0, 0, n)]
    )
    assert license_scan.scan(d.where("false")).isEmpty()


def test_licenses_at_the_limit_are_found_as_often_as_promised():
    """Windows that hold just the share of a template that counts, with other words round it and in its gaps."""
    r, t = random.Random(9), license_scan.Templates(license_scan.TEMPLATES, 0.8, 1e-3)
    name, text = license_scan.TEMPLATES[3]
    words = re.findall(r"[a-z0-9]+", text.lower())
    size = len({tuple(words[i : i + 5]) for i in range(len(words) - 4)})
    keep = words[: -(-8 * size // 10) + 4]  # the first four fifths of the shingles
    found, many = 0, 1500
    for _ in range(many):
        noise = lambda n: [f"w{r.randrange(10**9)}" for _ in range(n)]
        raw = " ".join([*noise(r.randrange(300)), *keep, *noise(400)]).encode()
        d = np.frombuffer(raw, np.uint8)
        place, row, g, _ = license_scan.shingled(d, np.array([0]), np.array([len(d)]))
        found += any(t.names[i] == name and share >= 0.8 for _, i, share, _, _ in t.matches(place, row, g))
    assert found >= many - 8  # 1.5 misses are promised at most in the mean


def test_quality_model(spark, hard):
    texts, d = hard
    labels = spark.createDataFrame([(1, 1, "v"), (1, 1, "v"), (1, 0, "v"), (9, 0, None), (None, 1, "v"), (5, None, "v")], "doc_id long, quality int, score string")
    rows = quality_model.score(d, quality_model.train(d, labels)).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in texts) and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (2, 3)}) == 1 and len({r["score"] for r in rows if r["doc_id"] in (5, 6)}) == 1
    assert {r["score"] for r in quality_model.score(d, quality_model.train(d, labels.where("false"))).collect()} == {0.3}


def test_sentence_pieces(hard):
    texts, d = hard
    rows = sentence_pieces.encode(d).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in texts) and all(r["lossless"] for r in rows if r["ids"] is not None)
    assert sorted(len(r["ids"]) if r["ids"] is not None else -1 for r in rows if r["doc_id"] in (2, 3)) == [-1, 0]
    same = [tuple(r["ids"]) for r in rows if r["doc_id"] == 1]
    assert same[0] == same[1]
    back = Counter(r["text"] for r in sentence_pieces.decode(sentence_pieces.encode(d)).collect())
    assert back == Counter(t for _, t in texts)


def test_suffix_dedup(hard):
    texts, d = hard
    rows = suffix_dedup.dedup(d).collect()
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in rows)
    assert sum(got.values()) == len(texts) and {k[:2] for k in got} == {(i, len((t or "").encode())) for i, t in texts}
    long = len(texts[7][1])
    assert got[6, long, long] == 1 and got[5, long, 4999] == 1  # a hundred y's start again from the second one on
    assert Counter(r["n_removed"] for r in rows if r["doc_id"] == 1) == Counter({len(texts[0][1]) - 37: 2})
    assert all(r["n_removed"] == 0 for r in rows if r["doc_id"] in (2, 3, 4, 7, 8, 9))


def test_columns_to_keep_have_any_type(hard):
    _, d = hard
    out = decontamination.decontaminate(d.select("doc_id", "text", F.lit(3).alias("a")), d.select(F.col("doc_id").alias("item_id"), "text"), keep=("a",))
    assert out.where("a <> 3").isEmpty()
