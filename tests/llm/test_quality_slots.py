"""Slots of the quality classifier: the short way of plain words is the long way's, and vectors pool alike in any shares."""

import re

import numpy as np
import xxhash

from tabmine.llm import quality as q


def by_rules(token: bytes) -> int:
    """The rules without the short way."""
    if not q.LETTER.search(token):
        if not re.search(rb"[0-9]", token):
            return q.WORD_SLOTS + (0 if len(token) == 1 else 1)
        return q.WORD_SLOTS + (2 if token.isalnum() else 3)
    if q.SYMBOL_TAIL.search(token):
        return q.WORD_SLOTS + 4
    word = q.EDGE.sub(b"", token)
    if len(word) > 1 and word.isascii() and word.isupper() or len(word) > 2 and word.decode("utf-8", "replace").isupper():
        return q.WORD_SLOTS + 5
    if re.search(rb"[0-9]", word):
        return q.WORD_SLOTS + (6 if b"@" in word or b"." in word else 7)
    if re.search(rb"[^A-Za-z\x80-\xff'-]", word):
        return q.WORD_SLOTS + 8
    return xxhash.xxh64_intdigest(word.lower()) % q.WORD_SLOTS


def test_slot_of_equals_the_rules():
    rng = np.random.default_rng(3)
    signs = [c.encode() for c in "aZbQé9.,!?;:@'-_(É"]
    tokens = [b"".join(signs[i] for i in rng.integers(0, len(signs), n)) for n in rng.integers(1, 7, 20_000)]
    tokens += [b"I", b"A.", b"OK", b"OK!", b"no", b"no?!", b".", b"..", b"Word,", b",word"]
    assert [q.slot_of(t) for t in tokens] == [by_rules(t) for t in tokens]


def test_plain_words_take_no_rules(monkeypatch):
    monkeypatch.setattr(q, "LETTER", None)  # what the rules begin with
    assert q.slot_of(b"Word,") == q.slot_of(b"word") == xxhash.xxh64_intdigest(b"word") % q.WORD_SLOTS
    assert q.slot_of(b"LOUD!") == q.WORD_SLOTS + 5


def test_pooled_is_the_weighted_mean():
    rng = np.random.default_rng(5)
    vectors, weight = rng.normal(size=(q.SLOTS, 6)), rng.random(q.SLOTS) + 0.1
    texts = [b"", *[b" ".join(rng.choice([b"one", b"two,", b"THREE", b"4", b"!!"], n)) for n in (1, 7, 30_000, 9)]]
    out = q.pooled(texts, q.Slots(), vectors, weight)
    for text, row in zip(texts, out):
        s, _ = q.slots_of([text], q.Slots())
        want = (vectors[s] * weight[s][:, None]).sum(0) / weight[s].sum() if len(s) else np.zeros(6)
        assert np.allclose(row[:6], want)
