"""Plain Python versions of the operators' contracts."""

import hashlib
import re
from itertools import combinations

WHITE, TOKEN = re.compile(rb"[^\x20\x09-\x0D]+"), re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return (text or "").encode().lower()


def shingles(text, k=5):
    w = WHITE.findall(lower(text))
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def components(docs):
    """docs: (id, text). {id: (shingles, component)}"""
    sets, parent = {d: shingles(t) for d, t in docs}, {d: d for d, _ in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 80 * len(x | y):
            parent[max(find(a), find(b))] = min(find(a), find(b))
    return {d: (len(s), find(d)) for d, s in sets.items()}


def repeats(docs, n=100):
    """docs: (id, text). {id: (bytes, removed, spans, sha256 of what is left)}"""
    seen, out = {}, {}
    docs = sorted((d, (t or "").encode()) for d, t in docs)
    for d, t in docs:
        for i in range(len(t) - n + 1):
            seen.setdefault(t[i : i + n], (d, i))
    for d, t in docs:
        gone = bytearray(len(t))
        for i in range(len(t) - n + 1):
            if seen[t[i : i + n]] != (d, i):
                gone[i : i + n] = b"\x01" * n
        left = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out[d] = (len(t), sum(gone), spans, hashlib.sha256(left).hexdigest())
    return out


def contamination(docs, items, size=10):
    """{id: (words, hit words, items)}"""
    windows = {}
    for i, t in items:
        w = TOKEN.findall(lower(t))
        for j in range(max(1, len(w) - size + 1)) if w else ():
            windows.setdefault(tuple(w[j : j + size]), set()).add(i)
    out = {}
    for d, t in docs:
        w, hit, own = TOKEN.findall(lower(t)), set(), set()
        for n in {len(x) for x in windows}:
            for j in range(len(w) - n + 1):
                if (found := windows.get(tuple(w[j : j + n]))) is not None:
                    hit |= set(range(j, j + n))
                    own |= found
        out[d] = (len(w), len(hit), sorted(map(str, own)))
    return out


def quality(text):
    """(words, characters, symbols, repeated lines, words in repeated windows)"""
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    twice = {g for g in grams if grams.count(g) > 1}
    cover = {i + k for i, g in enumerate(grams) if g in twice for k in range(5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover)


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def merkle(groups, fanout=2):
    """groups: {group: leaves in order}. (root, {group: (subroot, [(left, right), ...] of each leaf up to the root)})"""

    def tree(nodes):
        steps = [[] for _ in nodes]
        at = list(range(len(nodes)))
        while len(nodes) > 1:
            runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
            for leaf, p in enumerate(at):
                run, own = runs[p // fanout], p % fanout
                steps[leaf].append(("".join(run[:own]), "".join(run[own + 1 :])))
                at[leaf] = p // fanout
            nodes = [sha(*run) for run in runs]
        return nodes[0], steps

    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs = {g: tree(groups[g]) for g in order}
    root, above = tree([subs[g][0] for g in order])
    return root, {g: (subs[g][0], [own + above[i] for own in subs[g][1]]) for i, g in enumerate(order)}


def lines(docs, min_chars=20, min_docs=3):
    """docs: (id, text), one for each text. [(id, lines, dropped, what is left)]"""
    key = lambda line: line.strip(b" \t\n\x0b\x0c\r").lower()
    holders = {}
    for i, t in docs:
        for k in {key(x) for x in (t or "").encode().split(b"\n")}:
            if len(k.decode()) >= min_chars:
                holders.setdefault(k, []).append(i)
    last = lambda ids: max(ids, key=lambda i: (i is not None, i or 0))
    out = []
    for i, t in docs:
        all_of = (t or "").encode().split(b"\n")
        left = [x for x in all_of if len(holders.get(key(x), ())) < min_docs or last(holders[key(x)]) == i]
        out.append((i, len(all_of), len(all_of) - len(left), b"\n".join(left)))
    return out


def collocations(docs, min_count, longest=5, top=2000):
    """docs: (group, text). [(group, rank, phrase, a, l, r, n, score)]"""
    n, f = {}, {}
    for g, t in docs:
        g = "und" if g is None else g
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", lower(t)):
            w = re.findall(rb"[^\x20\x09]+", piece)
            n[g] = n.get(g, 0) + len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[g, tuple(w[i : i + k])] = f.get((g, tuple(w[i : i + k])), 0) + 1
    found = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= min_count}
    inside = {}
    for (g, p), a in found.items():
        for i in range(len(p)):
            for j in range(i + 2, len(p) + 1):
                if j - i < len(p):
                    inside[g, p[i:j]] = max(inside.get((g, p[i:j]), 0), a)
    rows = {}
    for (g, p), a in found.items():
        if inside.get((g, p), 0) < a:
            score, _, left, right = min((1000 * a * n[g] // (f[g, p[:k]] * f[g, p[k:]]), k, f[g, p[:k]], f[g, p[k:]]) for k in range(1, len(p)))
            rows.setdefault(g, []).append((-score, -a, b" ".join(p), left, right))
    out = []
    for g, own in rows.items():
        out += [(g, i + 1, p.decode(), -a, left, right, n[g], -s) for i, (s, a, p, left, right) in enumerate(sorted(own)[:top])]
    return sorted(out)
