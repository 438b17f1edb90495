"""The corpus pipeline as a whole, against brute force on a small folder of tables."""

import collections
import random

from test_corpus_ops import brute_classes, brute_hits, prose

import corpus_pipeline
from tabmine.llm import quality

DOC = "doc_id long, text string, source string, kept string, Score string, n_lines int"
BLANKS = " \t\n\x0b\x0c\r"


def fixture():
    """(documents, labels, benchmark, doc_ids with bad texts): some of every case that a stage decides on."""
    rng = random.Random(11)
    items = [(0, prose(rng, 20, 9000)), (1, prose(rng, 13, 9000)), (2, prose(rng, 5, 9000)), (3, None)]
    texts = {i: "\n".join(prose(rng, rng.randrange(15, 40)) for _ in range(3)) for i in range(120)}
    for i in range(0, 30, 2):  # a line in many documents, once in a form of its own
        texts[i] += "\n  Read  the REST here \t" if i % 4 else "\nread  the rest here"
    for i in range(5):  # a line in too few
        texts[40 + i] += "\nin five only"
    for i in range(40):  # near copies in a chain of edits, and exact ones
        w = texts[i % 4].split(" ")
        w[rng.randrange(20, 30)] = f"edit{i}x"
        texts[200 + i] = " ".join(w) if i % 3 else texts[i % 4]
    for i, (_, s) in enumerate(items[:3]):
        texts[300 + i] = f"{prose(rng, 20)} {s.upper()} {prose(rng, 20)}"
        texts[310 + i] = f"{prose(rng, 20)}\n{s}\n{prose(rng, 600)}"  # a small part of the text
    bad = {400 + i: " ".join(f"BUY{rng.randrange(30)}!!" for _ in range(30)) for i in range(60)}
    labels = [(i, int(i not in bad)) for i in texts | bad] + [(0, None), (None, 1)]
    texts = texts | bad | {900: None, 901: "", 902: " \n "}
    rows = [(i, t, "hot" if i % 3 else f"s{i % 5}", "own", f"own{i}", -1) for i, t in texts.items()]
    rows += [rows[50], (903, prose(rng, 30), None, None, None, None)]
    return rows, labels, items, set(bad)


def write(spark, folder, rows, labels, items):
    for name, data, schema in (("documents", rows, DOC), ("labels", labels, "doc_id long, quality int"),
                               ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(data, schema).repartition(2).write.parquet(f"{folder}/{name}.parquet")


def brute_rows(rows, items):
    """What stays of ``rows`` after lines, near copies and benchmark passages."""
    key = lambda x: x.strip(BLANKS).lower()  # noqa: E731  the fixture is ASCII
    often = collections.Counter(k for r in rows for k in {key(x) for x in (r[1] or "").split("\n")} - {""})
    hot = {k for k, n in often.items() if n >= 10}
    rows = [(r[0], r[1] and "\n".join(x for x in r[1].split("\n") if key(x) not in hot), *r[2:]) for r in rows]
    groups = collections.defaultdict(list)
    for r, c in zip(rows, brute_classes([r[:2] for r in rows])):
        groups[c].append(r)
    rows = [min(g, key=lambda r: r[0]) for g in groups.values()]
    hits = [brute_hits(r[1], items) for r in rows]
    return [r for r, (n, hit, _) in zip(rows, hits) if not (hit and 20 * hit >= n)]


def test_pipeline(spark, tmp_path):
    rows, labels, items, bad = fixture()
    write(spark, tmp_path, rows, labels, items)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    judged = quality.score_quality(docs.select("doc_id", "text"), spark.read.parquet(f"{tmp_path}/labels.parquet"))
    good = {r.doc_id for r in judged.filter("predicted = 1").collect()}
    assert not good & bad and {r[0] for r in rows if r[0] < 400} <= good
    want = brute_rows([r for r in rows if r[0] in good], items)
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == [*docs.columns, "slot", "block", "mix_pos"]
    got = out.collect()
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted(want, key=repr)
    assert {300, 301, 302} & {r.doc_id for r in got} == set() and {310, 311, 312} <= {r.doc_id for r in got}
    got.sort(key=lambda r: r.mix_pos)
    assert [r.mix_pos for r in got] == list(range(len(want)))
    assert [r.slot for r in got] == sorted(r.slot for r in got)


def test_pipeline_empty(spark, tmp_path):
    write(spark, tmp_path, [], [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
