r"""Personal data by bootstrapped contextual extraction.

Fixed patterns find the seed entities: emails, IPv4 addresses, payment cards,
phone numbers. The two tokens before each seed are its lexical pattern; every
other identifier-like token (one with a digit or an at sign), and every run of
such tokens beside one another, with its two tokens before is an instance not
labelled yet. Spark scores the graph of
patterns and instances in rounds: a pattern is as sure as the instances it
takes in, an instance as sure as the other patterns that take it in. Sure patterns
then mark the instances nobody had seen.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmine.llm.common import stage, text_of

KINDS = ("email", "ip", "card", "phone")
#: What the base entities look like.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
MARK = re.compile("[0-9@]")
#: Shorter values are no identifier of any kind.
LEAST = 5
EDGE = "\"'`()[]{}<>.,;:!?=*#$%&"
WORD = re.compile(r"\S+")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, at sign and domain, found from each at sign."""
    done, at = 0, text.find("@")
    while at >= 0:
        a = at
        while a > done and text[a - 1] in LOCAL_CHARS:
            a -= 1
        m = DOMAIN.match(text, at + 1) if a < at else None
        if m:
            done = m.end()
            yield a, done
        else:
            done = max(done, a)
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base entities, sorted."""
    out = [(a, 0, b) for a, b in emails(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p[-4:]) <= 255 and len(p.lstrip("0")) < 4 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if 12 <= m.end() - m.start() <= 40:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text)
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def context(text: str, start: int, words: list[tuple[int, int]], starts: list[int]) -> str:
    """The two tokens before ``start``, lower-cased, digits as 0; marked where the text begins.

    ``words`` are the places of the text's tokens, ``starts`` where they begin.
    """
    i = bisect_left(starts, start)
    before = [text[a:min(b, start)] for a, b in words[max(0, i - 2):i]]
    return re.sub("[0-9]", "0", " ".join(["^"] * (2 - len(before)) + before).lower())


def trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    """``a`` and ``b`` without the marks around a value; a parenthesis that closes inside it stays."""
    value = text[a:b]
    end = a + len(value.rstrip(EDGE))
    start = b - len(value.lstrip(EDGE))
    if start > a and text[start - 1] == "(" and ")" in text[start:end]:
        start -= 1
    elif start < end < b and text[end] == ")" and "(" in text[start:end]:
        end += 1
    return start, end


def runs(text: str, words: list[tuple[int, int]], spans: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int]]]:
    """Tokens with a digit or an at sign beside one another on a line; a seed or the end of a clause ends a run."""
    i, reach, run = 0, 0, []
    for a, b in words:
        while i < len(spans) and spans[i][0] < b:
            reach = max(reach, spans[i][2])  # spans are sorted by start
            i += 1
        own = reach <= a and MARK.search(text, a, b)
        if run and (not own or "\n" in text[run[-1][1]:a]):
            yield run
            run = []
        if own:
            run.append((a, b))
            if text[b - 1] in ",;:.!?":
                yield run
                run = []
    if run:
        yield run


def instances(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str, str, int, bool]]:
    """(start, kind, end, value, pattern, run, whole): the seeds, and with kind -1 the other identifier-like tokens
    and whole runs of several; run is where a token's or a run's run starts."""
    words = [m.span() for m in WORD.finditer(text)]
    starts = [a for a, _ in words]
    out = [(a, k, b, text[a:b].lower(), context(text, a, words, starts), a, False) for a, k, b in spans]
    for run in runs(text, words, spans):
        parts = [(*w, False) for w in run]
        if len(run) > 1:
            parts.append((run[0][0], run[-1][1], True))
        for a, b, whole in parts:
            a, b = trimmed(text, a, b)
            if b - a >= LEAST and MARK.search(text, a, b):
                out.append((a, -1, b, text[a:b].lower(), context(text, a, words, starts), run[0][0], whole))
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    one = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
    two = pa.struct([*one, ("value", pa.string()), ("pattern", pa.string()), ("run", pa.int32()), ("whole", pa.bool_())])
    for batch in batches:
        spans, found = [], []
        for t in batch.column(1).to_pylist():
            s = base_spans(t or "")
            spans.append([dict(zip(("start", "kind", "end"), x)) for x in s])
            found.append([dict(zip(two.names, x)) for x in instances(t or "", s)])
        yield pa.record_batch([batch.column(0), pa.array(spans, pa.list_(one)), pa.array(found, pa.list_(two))], ["id", "base", "found"])


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3,
                       support: int = 5, sure: float = 0.8) -> DataFrame:
    """One row per row of ``docs``: id_col, base and spans, arrays of (start, kind, end) sorted by start, kind.

    Kinds are places in ``KINDS``; positions are code points, end exclusive.
    ``base`` holds what the fixed patterns find; ``spans`` adds what the sure
    patterns discover. A pattern counts for a kind once it takes in at least
    ``support`` different instances; its confidence is the mean certainty of
    its instances (seeds of the kind 1, of another kind 0, others the most that one
    of their other patterns had the round before, at first 0): a pattern never
    vouches for itself. Instances of a pattern
    with confidence ``sure`` or more are taken in, those of several kinds by the
    surest pattern; a run that is taken in goes before the tokens inside it.
    Clean texts have no spans.

    Null counts as the empty text. Repeated rows are searched each. An empty
    table gives an empty result; further columns are not read. Only (pattern,
    value) counts are shuffled, combined before the shuffle; texts never are.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    span = "array<struct<start: int, kind: int, end: int>>"
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("x")).mapInArrow(
        _scan, f"id {kind}, base {span}, found array<struct<start: int, kind: int, end: int, value: string, pattern: string, "
        "run: int, whole: boolean>>")
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "pii-rows")
    found = rows.select("row", F.explode("found").alias("f")).select("row", "f.*")
    # the graph: one edge per pattern and value; a value once seen as a seed is one
    edges = found.groupBy("pattern", "value").agg(F.max("kind").alias("kind"))
    # only patterns with enough different values can ever count
    busy = edges.groupBy("pattern").agg(F.count("*").alias("n"), F.max("kind").alias("k")).filter(
        (F.col("n") >= support) & (F.col("k") >= 0)).select("pattern", "n")
    edges = stage(edges.join(busy, "pattern"), "pii-edges")
    kinds = F.explode(F.array(*[F.lit(k) for k in range(len(KINDS))])).alias("k")
    belief = None
    for i in range(rounds):
        seen = edges.select("pattern", "value", "kind", "n", kinds)
        if belief is None:
            seen = seen.withColumn("r", F.lit(0.0))
        else:  # a pattern doesn't vouch for itself: what the value has from its other patterns counts
            seen = seen.join(belief, ["value", "k"], "left").withColumn(
                "r", F.coalesce(F.when(F.col("pattern") == F.col("top.pattern"), F.col("next")).otherwise(F.col("top.trust")), F.lit(0.0)))
        seed = F.when(F.col("kind") == F.col("k"), 1.0).when(F.col("kind") >= 0, 0.0).otherwise(F.col("r"))
        trust = stage(seen.groupBy("pattern", "k").agg((F.sum(seed) / F.max("n")).alias("trust")).filter("trust > 0"),
                      "pii-patterns")
        if i + 1 < rounds:
            given = edges.filter("kind < 0").select("pattern", "value").join(trust, "pattern")
            top = given.groupBy("value", "k").agg(F.max(F.struct("trust", "pattern")).alias("top"))
            top = stage(top, "pii-instances")
            after = (given.join(top, ["value", "k"]).filter(F.col("pattern") != F.col("top.pattern"))
                     .groupBy("value", "k").agg(F.max("trust").alias("next")))
            belief = stage(top.join(after, ["value", "k"], "left"), "pii-beliefs")
    best = trust.filter(F.col("trust") >= sure).groupBy("pattern").agg(
        F.max(F.struct("trust", (-F.col("k")).alias("k"))).alias("b")).select("pattern", (-F.col("b.k")).cast("int").alias("k"))
    one = F.struct("start", F.col("k").alias("kind"), "end")
    new = (found.filter("kind < 0").join(best, "pattern").groupBy("row", "run")
           .agg(F.collect_list(F.when(~F.col("whole"), one)).alias("parts"), F.max(F.when(F.col("whole"), one)).alias("all"))
           .withColumn("new", F.when(F.col("all").isNull(), F.col("parts")).otherwise(F.array("all")))
           .groupBy("row").agg(F.flatten(F.collect_list("new")).alias("new")))
    out = rows.select("row", "id", "base").join(new, "row", "left")
    spans = F.array_sort(F.concat("base", F.coalesce("new", F.array().cast(span))))
    return out.select(F.col("id").alias(id_col), "base", spans.alias("spans"))


def written(spans):
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
