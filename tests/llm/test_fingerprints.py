"""Fingerprints against sets and densification worked out one by one."""

import random
from hashlib import sha256

import numpy as np
import pytest

from tremorlake.llm import fingerprints, textkit
from tremorlake.llm.queries import QUERIES

EMPTY = np.iinfo(np.uint64).max


def _runs(text):
    words = text.split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def _mark(text):
    """The fingerprint, bin by bin."""
    data = text.encode()
    hashes = textkit.Words([data]).ngrams(5)[0].tolist() or [int.from_bytes(sha256(data).digest()[:8], "big") ^ int(fingerprints._SALT)]
    least = {}
    for h in hashes:
        b, value = h >> 55, h & (1 << 55) - 1
        least[b] = min(least.get(b, value), value)
    order, out = fingerprints._loans()[0], []
    for b in range(512):
        lender = b if b in least else next(c for c in order[b].tolist() if c in least)
        out.append(f"{int(textkit.mix(np.array([least[lender]], dtype=np.uint64))[0]) & 15:x}")
    return "".join(out)


def _near(a, b):
    return min(1.0, max(0.0, (sum(x == y for x, y in zip(a, b)) / 512 - 1 / 16) / (15 / 16)))


def _by_hand(rows):
    """One answer per row (doc_id, text)."""
    docs = sorted({(i is None, i or 0, t or "") for i, t in rows}, key=lambda d: (d[0], d[1], d[2]))
    out = {}
    for k, (absent, i, text) in enumerate(docs):
        following = docs[(k + 1) % len(docs)][2]
        n = len(text) // 4
        changed = text[:len(text) - n] + following[:n]
        a, b, c = _mark(text), _mark(changed), _mark(following)
        out[None if absent else i, text] = (len(text), sha256(changed.encode()).hexdigest(), a, b, round(_near(a, b), 9), round(_near(a, c), 9))
    return sorted(((i, *out[i, t or ""]) for i, t in rows), key=repr)


def _rows(frame):
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9))
                   for r in frame.collect()), key=repr)


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert _rows(QUERIES["op11_fingerprints"](spark, sf_dir)) == _by_hand(rows)


def test_odd_rows(documents, odd_rows):
    one_text_per_id = [r for r in odd_rows if r[0] is not None] + [(None, "no id")] * 300 + [(14, "漢字" * 9), (15, "𝒳" * 40), (16, "a b c d e f")]
    got = fingerprints.neighbours(documents(one_text_per_id).repartition(7))
    assert _rows(got) == _by_hand(one_text_per_id)
    assert fingerprints.neighbours(documents(odd_rows)).count() == len(odd_rows)
    assert fingerprints.neighbours(documents([])).count() == 0
    alone = fingerprints.neighbours(documents([(5, "one two three four five six seven")] * 2)).collect()
    assert [r.near_next for r in alone] == [1.0, 1.0] and alone[0] == alone[1]
    assert [(r.near_next, r.n_chars) for r in fingerprints.neighbours(documents([(None, None)])).collect()] == [(1.0, 0)]


def test_texts_under_one_id_form_one_ring(documents):
    """A third of all rows under one id, and as many without any: each is the next of exactly one other."""
    rows = [(7, f"text {i}") for i in range(200)] + [(None, f"none {i}") for i in range(200)] + [(10 + i, f"own {i}") for i in range(200)]
    got = fingerprints.neighbours(documents(rows).repartition(6)).collect()
    assert len(got) == 600
    texts = {sha256((a[:len(a) - len(a) // 4] + b[:len(a) // 4]).encode()).hexdigest() for _, a in rows for b in ("text", "none", "own ")}
    assert {r.edited_sha256 for r in got} <= texts


@pytest.mark.parametrize("full", [1, 3, 24, 25, 100, 400, 512])
def test_densification_lends_evenly(full):
    rng = np.random.default_rng(full)
    values = np.full((40, 512), EMPTY, dtype=np.uint64)
    for row in values:
        row[rng.choice(512, full, replace=False)] = rng.integers(1, 1 << 40, full)
    out = fingerprints.densified(values)
    assert (out != EMPTY).all() and (out[values != EMPTY] == values[values != EMPTY]).all()
    order = fingerprints._loans()[0]
    for row, dense in zip(values[:5], out):
        for b in range(512):
            assert dense[b] == next(row[c] for c in [b, *order[b]] if row[c] != EMPTY)
    if full <= 100:  # beyond, a bin lends once or twice
        borrowed = [np.unique(o[v == EMPTY], return_counts=True)[1].max() / (512 - full) * full for v, o in zip(values, out)]
        assert np.mean(borrowed) < 8  # no full bin lends to most of the empty ones


def test_estimates_are_unbiased():
    rng = random.Random(1)
    errors = []
    for k in range(60):
        words = [f"w{rng.randrange(10 ** 6)}" for _ in range(rng.choice([60, 400, 3000]))]
        other = list(words)
        at = rng.randrange(len(words) // 2)
        for i in range(at, at + len(words) // rng.choice([3, 10, 30])):
            other[i] = f"x{rng.randrange(10 ** 6)}"
        a, b = " ".join(words), " ".join(other)
        true = len(_runs(a) & _runs(b)) / len(_runs(a) | _runs(b))
        marks = fingerprints.fingerprints([a.encode(), b.encode()])
        errors.append(fingerprints.likeness(marks[:1], marks[1:])[0] - true)
    assert abs(np.mean(errors)) < 0.015 and np.max(np.abs(errors)) < 0.15
