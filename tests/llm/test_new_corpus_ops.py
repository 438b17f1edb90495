"""Spelling variants, manifest and substring dedup against brute force: nulls, empty and long texts, ties,
repeated rows, empty tables, columns with clashing names."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabmine.llm import anchors, merkle, permuterm
from tabmine.llm.queries import spoilt_words

DOC = "doc_id long, text string, cuts string, kept string, `from` string, source string, id string"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "c", "k", "f", s, "x") for i, t, s in texts], DOC)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# --- spelling variants

def near(a, b):
    """One inserted, deleted or replaced code point makes one the other."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(n, times=5):
    form, out = {}, {}
    for w in n:
        others = sorted((-n[o], o) for o in n if near(w, o))
        form[w] = others[0][1] if others and -others[0][0] >= times * n[w] else None
        out[w] = len(others)
    rows = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n[w], out[w], n.get(form[w])))
    return sorted(rows)


def test_variants(spark):
    rng = random.Random(3)
    n = {"aab": 3, "ab": 20, "aaab": 1, "b": 5, "é": 2, "ééé": 9, "eéé": 9, "abab": 1, "baba": 1, "babab": 700, "bab": 1000, "xy": 4, "yx": 4}
    n |= {"".join(rng.choice("abcé") for _ in range(rng.randrange(1, 7))): rng.choice([1, 1, 2, 5, 5, 25, 125, 3000]) for _ in range(250)}
    rows = [(w, c, "x", "y") for w, c in n.items()] + [(None, 4, "", ""), ("", 9, "", "")]
    df = spark.createDataFrame(rows, "word string, n long, form string, prefix string")
    got = sorted(tuple(r) for r in permuterm.group_variants(df).collect())
    assert got == variants(n)
    assert any(r[2] != r[1] for r in got if r[1])  # chains of forms occur
    twice = permuterm.group_variants(df.union(df))  # rows of one word are added up
    assert sorted((r.word, r.n) for r in twice.collect()) == sorted((w, 2 * c) for w, c in n.items())
    assert permuterm.group_variants(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        permuterm.group_variants(df, times=1)


def test_a_long_word_and_a_full_range(spark):
    long = "q" * 3000
    n = {long: 50, long[:-1]: 3, "x" + long[1:]: 4} | {f"star{c}d": i + 1 for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")} | {"stard": 900}
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    assert sorted(tuple(r) for r in permuterm.group_variants(df).collect()) == variants(n)


def test_spoilt_words(spark):
    import zlib
    texts = [(i, f"Straße straße ÀPFEL ab garden7garden GARDENÉ-{'letter ' * (i % 3)}", None) for i in range(300)] + [(None, "garden", None), (5, None, None)]
    want = collections.Counter()
    for i, t, _ in texts:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            want[run] += 1
    got = {r.word: r.n for r in spoilt_words(docs_of(spark, texts), often=1).collect()}
    assert got == {w: c for w, c in want.items() if len(w) >= 6}
    assert len(got) > 4 and spoilt_words(docs_of(spark, [])).count() == 0


# --- manifest

def brute_tree(level):
    """Digest of a tree and the siblings of each leaf, by level."""
    paths, at = [[] for _ in level], [[i] for i in range(len(level))]
    while len(level) > 1:
        up, over = [], []
        for a in range(0, len(level), 3):
            run = level[a:a + 3]
            for j, i in enumerate(range(a, a + len(run))):
                for leaf in at[i]:
                    paths[leaf].append((j, [d for k, d in enumerate(run) if k != j]))
            up.append(sha("".join(run)))
            over.append([x for i in range(a, a + len(run)) for x in at[i]])
        level, at = up, over
    return level[0], paths


@pytest.mark.parametrize("height", [1, 2, 6])
def test_manifest(spark, height):
    texts = [(i, f"text\n{i}", "a") for i in range(31)] + [(i, "one", "B") for i in range(3)] + [(7, "same", "ü")] * 14 + [
        (1, "z", None), (None, "no id", "a"), (2, None, ""), (3, "", "lone"), (4, "x" * 200_000, None), (5, "y", "a"), (5, "a", "a")]
    docs = docs_of(spark, texts).repartition(3)
    made = merkle.manifest(docs, F.col("source"), F.col("doc_id"), merkle.leaf_of(F.col("doc_id"), F.col("text")),
                           {"doc_id": F.col("doc_id"), "text": F.col("text")}, height=height)
    rows = made.proofs().withColumn("back", merkle.fold(F.col("leaf"), F.col("path"))).collect()

    def said(x):
        return "-" if x is None else f"{len(str(x).encode())}:{x}"
    trees = collections.defaultdict(list)
    for i, t, s in texts:
        trees["-" if s is None else "=" + s].append((i is not None, i or 0, sha(said(i) + said(t)), t))
    names = sorted(trees, key=lambda s: s.encode())
    assert names[0] == "-"
    subs = {s: brute_tree([x[2] for x in sorted(trees[s], key=lambda x: x[:3])]) for s in names}
    root, over = brute_tree([subs[s][0] for s in names])
    want = []
    for k, s in enumerate(names):
        for x, path in zip(sorted(trees[s], key=lambda x: x[:3]), subs[s][1]):
            want.append((s, x[2], subs[s][0], root, repr(path + over[k]), root))
    got = [(r.tree, r.leaf, r.subroot, r.root, repr([(p["at"], list(p.others)) for p in r.path]), r.back) for r in rows]
    assert sorted(got) == sorted(want)
    assert all(r.leaf == sha(said(r.ask.doc_id) + said(r.ask.text)) for r in rows)
    # the records alone lead from the root to every leaf
    records = {r.digest: r.children for r in made.records().collect()}
    assert all(sha("".join(c)) == d for d, c in records.items())
    seen, todo = set(), [root]
    while todo:
        d = todo.pop()
        seen.add(d)
        todo += records.get(d, [])
    assert {r.leaf for r in rows} <= seen


def test_manifest_empty_and_tampered(spark):
    none = merkle.manifest(docs_of(spark, []), F.col("source"), F.col("doc_id"), merkle.leaf_of(F.col("text")))
    assert none.root().count() == 0 and none.proofs().count() == 0
    docs = docs_of(spark, [(i, f"t{i}", "s") for i in range(10)])
    rows = merkle.manifest(docs, F.col("source"), F.col("doc_id"), merkle.leaf_of(F.col("text"))).proofs()
    rows = rows.select("root", merkle.fold(merkle.leaf_of(F.lit("other")), F.col("path")).alias("back")).collect()
    assert len(rows) == 10 and all(r.back != r.root for r in rows)


# --- substring dedup

def brute_repeats(texts, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, _ in texts]
    ids = [float("inf") if i is None else i for i, _, _ in texts]
    low = {}
    for i, w in zip(ids, words):
        for s in range(len(w) - window + 1):
            k = tuple(w[s:s + window])
            low[k] = min(low.get(k, i), i)
    out = []
    for (i, t, _), me, w in zip(texts, ids, words):
        gone = {p for s in range(len(w) - window + 1) if low[tuple(w[s:s + window])] < me for p in range(s, s + window)}
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window, cover, period, limit", [(50, anchors.COVER, 31, 1 << 25), (50, anchors.COVER, 31, 0),
                                                          (9, (0, 1, 3), 7, 1 << 25), (3, (0, 1), 3, 1 << 25)])
def test_repeats(spark, window, cover, period, limit):
    rng = random.Random(window)

    def prose(n):
        return " ".join(rng.choice(["a", "bé", "c,", "D"]) + str(rng.randrange(40)) for _ in range(n))
    shared = [prose(window + d) for d in (-1, 0, 1, 40)]
    texts = [(i, prose(rng.randrange(30)) + rng.choice(["\n", "  ", "\x0b"]) + rng.choice(shared) + " " + prose(rng.randrange(30)), None) for i in rng.sample(range(900), 60)]
    texts += [(2000, shared[3] + "\t" + shared[2], None), (2001, shared[3] * 2, None), (2002, "x " * 300, None), (2003, "x " * 120 + "y", None)]
    texts += [(2004, texts[5][1], None)] * 3 + [(2005, shared[3], None), (2005, shared[3] + " tail", None)]
    texts += [(None, shared[3], None), (None, None, None), (2006, "", None), (2007, " \n ", None), (2008, prose(20_000), None), (2009, "word", None)]
    texts += [(2010, texts[-2][1][3:], None), (2011, "no gap here " * window, None)]
    out = anchors.drop_repeats(docs_of(spark, texts), window=window, cover=cover, period=period, broadcast_bytes=limit)
    assert sorted(out.columns) == sorted("doc_id text cuts kept from source id n_words n_removed".split())
    rows = out.collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in rows), key=repr) == brute_repeats(texts, window)
    assert all((r.cuts, r["from"], r.id) == ("c", "f", "x") for r in rows)


def test_repeats_empty_and_bad_cover(spark):
    assert anchors.drop_repeats(docs_of(spark, [])).count() == 0
    for cover, period, window in (((0, 1, 2), 7, 50), ((0, 1, 3), 7, 5)):
        with pytest.raises(ValueError):
            anchors.drop_repeats(docs_of(spark, []), window=window, cover=cover, period=period)


def test_word_hashes_do_not_depend_on_pieces(monkeypatch):
    text = ("alpha beta\tgamma " * 50 + "x" * 5000 + "\n" + "tail é " * 30).encode()
    whole = anchors.word_hashes(text)
    assert len(whole) == len(text.split())
    monkeypatch.setattr(anchors.pieces, "__defaults__", (64,))
    assert np.array_equal(anchors.word_hashes(text), whole)
    by_word = collections.defaultdict(set)
    for w, h in zip(text.split(), whole.tolist()):
        by_word[w].add(h)
    assert all(len(v) == 1 for v in by_word.values()) and len(set.union(*by_word.values())) == len(by_word)
