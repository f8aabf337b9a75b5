"""Ranked search against scores worked out one by one."""

import math
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from tremorlake.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _by_hand(docs, items, k):
    """(item_id, rank, doc_id, score) of rows (doc_id, text) for rows (item_id, text)."""
    held = [(i, Counter(_terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    total, df = sum(sum(c.values()) for _, c in held), Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in held:
            m = 50 + 50 * sum(c.values()) * len(held) // total
            score = sum(math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m))
                        for t in set(_terms(text)) if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, n + 1, row[3], -row[0]) for n, row in enumerate(sorted(found)[:k])]
    return out


def _rows(frame):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in frame.collect()), key=repr)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(13)
    words = [f"w{i}" for i in range(300)] + ["é", "漢字", "x9"]
    text = lambda n: " ".join(words[int(len(words) * rng.random() ** 3)] for _ in range(n))
    docs = [(i, text(rng.randint(1, 120))) for i in range(900)]
    items = [(i, text(rng.choice([1, 3, 12, 40, 90]))) for i in range(30)]
    docs += [(1000 + i, docs[i][1].upper()) for i in range(60)] + [(2000 + i, items[i % 30][1]) for i in range(90)]
    return docs, items


@pytest.mark.parametrize(("cells", "item_bytes"), [(1 << 23, 1 << 22), (1 << 13, 1500)])
def test_search_equals_brute_force(spark, documents, corpus, monkeypatch, cells, item_bytes):
    monkeypatch.setattr(ranked_search, "CELLS", cells)
    monkeypatch.setattr(ranked_search, "ITEMS_BYTES", item_bytes)
    docs, items = corpus
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'a' AS terms", "1 AS id", "2 AS item")
    got = ranked_search.search(documents(docs).repartition(5), table, k=20)
    assert _rows(got) == sorted(_by_hand(docs, items, 20), key=repr)


def test_masks_and_bounds(corpus):
    docs, items = corpus
    words = ranked_search.Vocabulary([sorted(set(_terms(t))) for _, t in items])
    lists = [Counter(_terms(t)) for _, t in docs]
    number = {t: n for own, (_, text) in zip(words.items, items) for n, t in zip(own, sorted(set(_terms(text)), key=lambda t: np.searchsorted(
        words.hash, ranked_search.Words([t.encode()]).hash[0])))}
    frame = pd.DataFrame({
        "absent": False, "id": range(len(docs)), "terms": [sum(c.values()) for c in lists],
        "codes": [np.array([number[t] for t in c if t in number], dtype="<u4").tobytes() for c in lists],
        "times": [np.array([n for t, n in c.items() if t in number], dtype="<u4").tobytes() for c in lists]})
    lot = ranked_search.Lot(frame, len(words.hash), len(docs), int(frame.terms.sum()))
    df = np.array([sum(t in c for c in lists) for t in sorted(number, key=number.get)])
    scored = 0
    for item, (_, text) in zip(words.items, items):
        masks, order, begin = lot.groups(item)
        for g, mask in enumerate(masks):
            for d in order[begin[g]:begin[g + 1]]:
                assert {int(c) for c in item[mask == 1]} == {number[t] for t in set(_terms(text)) if t in lists[d]}
        assert len({m.tobytes() for m in masks}) == len(masks) and sorted(order) == [
            d for d, c in enumerate(lists) if any(t in c for t in _terms(text))]
        best = ranked_search.Best(5)
        scored += ranked_search.search_lot(lot, item, ranked_search.weights(len(docs), df)[item], best) / max(1, len(order))
        exact = (lot.share[item] * ranked_search.weights(len(docs), df)[item][:, None]).sum(axis=0)
        assert best.score.tolist() == sorted((s for s in exact.tolist() if s > 0), reverse=True)[:5]
    assert scored < 0.75 * len(items)  # a good part of the documents is never scored


def test_odd_rows(spark, documents, odd_rows):
    docs = documents(odd_rows)
    items = [(1, "word"), (None, "text words"), (2, None), (3, ""), (4, "..."), (1, "word"), (5, odd_rows[5][1]), (6, "É é 漢字")]
    table = spark.createDataFrame(items, "item_id long, text string")
    assert _rows(ranked_search.search(docs, table, k=3)) == sorted(_by_hand(odd_rows, items, 3), key=repr)
    assert ranked_search.search(docs, table.limit(0)).count() == ranked_search.search(docs.limit(0), table).count() == 0


def test_length_factors_beyond_64_bit():
    n = np.array([1, 10 ** 9], dtype=np.int64)
    assert ranked_search.length_factors(n, 10 ** 11, 10 ** 14).tolist() == [50, 50 + 50 * 10 ** 20 // 10 ** 14]
