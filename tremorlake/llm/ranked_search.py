"""Ranked lexical search over presence masks.

The documents of a table are ranked for each item of a query set by the terms they share. A term is a word of :mod:`textkit` (a run of
ASCII letters and digits and of non-ASCII characters, A-Z as a-z).

1. *Postings.* One pass over all texts keeps, of each document, its number of terms and the items' terms in it with their counts.
2. *Statistics.* Documents, terms and the document frequency of each item term are counted over these rows.
3. *Masks.* A task takes documents in lots and keeps a bitmap over the lot per term. An item's bitmaps, read across, give every document
   the mask of the terms it holds; documents of one mask form a group.
4. *Ranking.* The largest share a term has in any document of the lot bounds the score of a mask. Groups are scored exactly in
   descending order of that bound, until the next bound lies below the ``k``-th best score the task knows for the item; what is left
   cannot reach the list. Each task gives its best ``k`` of an item, and the best of these are the answer.

The score is the integer formula of :func:`weights` and :func:`shares`. Items are worked off in blocks of ``ITEMS_BYTES`` of terms,
so neither driver nor task holds more than one block of them; documents are never held beyond a lot. Words are told apart by 64-bit hashes: a
word of the corpus is taken for another term with a chance of the number of terms in 2^64.

Defined results: null and empty texts, and texts without terms, aren't counted as documents and are never found; an item without
terms finds nothing; each row of the items is an item of its own, so repeated rows repeat their lists; each row of the documents is a
document of its own; equal scores go by doc_id, null last; empty tables give an empty result; other columns are not read.
"""

from collections.abc import Iterable, Iterator
from math import floor, log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tremorlake.llm.shipping import ship
from tremorlake.llm.textkit import Words, as_bytes, slices
from tremorlake.session import work_folder

#: Documents of an item's list.
BEST = 50
#: Bytes of item terms that are looked for in one pass; a single longer item is a block by itself.
ITEMS_BYTES = 4 << 20
#: Terms times documents of a lot.
CELLS = 1 << 23
#: Documents scored at once, at least.
STEP = 64
#: Parts in which the lists of an item's tasks are cut down before they meet.
SPREAD = 64

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def weights(documents: int, frequency: np.ndarray) -> np.ndarray:
    """floor(1000 ln((2 N + 2) / (2 df + 1))) of each term."""
    return np.array([floor(1000 * log((2 * documents + 2) / (2 * int(df) + 1))) for df in frequency], dtype=np.int64)


def length_factors(terms: np.ndarray, documents: int, total: int) -> np.ndarray:
    """50 + (50 n N) div L of each document."""
    if len(terms) and 50 * int(terms.max()) * documents >= 1 << 62:  # beyond 64 bit on the way
        return np.array([50 + 50 * int(n) * documents // total for n in terms], dtype=np.int64)
    return 50 + 50 * terms * documents // total


def shares(times: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 20 m) for counts in documents of a length factor."""
    return 1_000_000_000 * times // (1000 * times + 20 * factor)


class Vocabulary:
    """The distinct terms of a block of items, numbered by their hash."""

    def __init__(self, items: list[list[str]]):
        terms = sorted({t for own in items for t in own})
        found = Words([t.encode("utf-8", "surrogatepass") for t in terms])
        self.hash = np.unique(found.hash)
        number = dict(zip(terms, np.searchsorted(self.hash, found.hash).tolist()))
        self.items = [np.array(sorted({number[t] for t in own}), dtype=np.int64) for own in items]


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).isNull().alias("absent"), F.coalesce(F.col(doc_id).cast("long"), F.lit(0)).alias("id"),
                       F.col(text).cast("string").alias("text"))


def postings(docs: DataFrame, hashes: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """absent, id, terms (all of the document), codes and times (uint32: the vocabulary's terms in it, and how often)."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = len(hashes)
        for batch in batches:
            at = 0
            for part in slices(as_bytes(batch.text)):
                found = Words(part)
                code = np.minimum(np.searchsorted(hashes, found.hash), max(0, size - 1))
                ours = np.flatnonzero(hashes[code] == found.hash) if size else code[:0]
                cell, times = np.unique(found.doc[ours] * max(1, size) + code[ours], return_counts=True)
                codes, times = (cell % max(1, size)).astype("<u4"), times.astype("<u4")
                first = np.searchsorted(cell // max(1, size), np.arange(len(part) + 1))
                own = batch.iloc[at:at + len(part)]
                frame = pd.DataFrame({
                    "absent": own.absent.to_numpy(), "id": own.id.to_numpy(), "terms": np.diff(found.first),
                    "codes": [codes[a:b].tobytes() for a, b in zip(first[:-1], first[1:])],
                    "times": [times[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]})
                yield frame[frame.terms > 0]
                at += len(part)

    return _rows(docs, doc_id, text).mapInPandas(run, "absent boolean, id long, terms long, codes binary, times binary")


def frequencies(found: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term of the vocabulary occurs."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.codes), dtype="<u4"), minlength=size)
        some = np.flatnonzero(total)
        yield pd.DataFrame({"code": some, "n": total[some]})

    out = np.zeros(size, dtype=np.int64)
    for row in found.select("codes").mapInPandas(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).collect():
        out[row.code] = row.n
    return out


class Lot:
    """Some documents: a bitmap over them and their shares for each term."""

    def __init__(self, frame: pd.DataFrame, size: int, documents: int, total: int):
        counts = np.array([len(c) // 4 for c in frame.codes], dtype=np.int64)
        code = np.frombuffer(b"".join(frame.codes), dtype="<u4").astype(np.int64)
        times = np.frombuffer(b"".join(frame.times), dtype="<u4").astype(np.int64)
        doc = np.repeat(np.arange(len(frame)), counts)
        factor = length_factors(frame.terms.to_numpy(), documents, total)
        self.share = np.zeros((size, len(frame)), dtype=np.int32)
        self.share[code, doc] = shares(times, factor[doc])
        held = np.zeros((size, len(frame)), dtype=bool)
        held[code, doc] = True
        self.bitmap = np.packbits(held, axis=1)
        self.largest = self.share.max(axis=1).astype(np.int64)
        self.absent, self.id = frame.absent.to_numpy(dtype=bool), frame.id.to_numpy(dtype=np.int64)

    def groups(self, item: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct masks (rows of bits by term) of documents with a term of the item; those documents, by mask, and where each begins."""
        rows = self.bitmap[item]
        some = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(rows, axis=0), count=len(self.id)))
        across = np.unpackbits(rows, axis=1, count=len(self.id))[:, some]
        mask = np.packbits(across, axis=0)
        wide = np.zeros((len(some), -(-len(mask) // 8) * 8), dtype=np.uint8)
        wide[:, :len(mask)] = mask.T
        words = wide.view(np.uint64)
        key = words[:, 0] if words.shape[1] == 1 else np.ascontiguousarray(words).view([("", np.uint64)] * words.shape[1])[:, 0]
        _, which = np.unique(key, return_inverse=True)
        order = np.argsort(which, kind="stable")
        begin = np.searchsorted(which[order], np.arange(which.max() + 2 if len(which) else 1))
        return across[:, order[begin[:-1]]].T, some[order], begin


class Best:
    """The best ``k`` documents of an item so far."""

    def __init__(self, k: int):
        self.k, self.score, self.absent, self.id = k, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool), np.zeros(0, dtype=np.int64)
        #: A score below this cannot enter the list.
        self.least = 1

    def add(self, score: np.ndarray, absent: np.ndarray, ids: np.ndarray) -> None:
        good = score >= self.least
        score, absent, ids = (np.concatenate(x) for x in (
            (self.score, score[good]), (self.absent, absent[good]), (self.id, ids[good])))
        first = np.lexsort((ids, absent, -score))[:self.k]
        self.score, self.absent, self.id = score[first], absent[first], ids[first]
        if len(first) == self.k:
            self.least = int(self.score[-1])


def search_lot(lot: Lot, item: np.ndarray, weight: np.ndarray, best: Best) -> int:
    """Brings an item's list up to a lot; returns how many documents had to be scored."""
    masks, docs, begin = lot.groups(item)
    bound = (masks * (weight * lot.largest[item])).sum(axis=1, dtype=np.int64)
    order = np.argsort(-bound, kind="stable")
    sizes, at, scored = np.diff(begin)[order], 0, 0
    ends = np.cumsum(sizes)
    while at < len(order) and bound[order[at]] >= best.least:
        upto = min(len(order), int(np.searchsorted(ends, scored + max(STEP, scored))) + 1)
        upto = at + int(np.searchsorted(-bound[order[at:upto]], -best.least, side="right"))  # none below the list
        own = np.concatenate([docs[begin[g]:begin[g + 1]] for g in order[at:upto]])
        best.add((lot.share[np.ix_(item, own)] * weight[:, None]).sum(axis=0, dtype=np.int64), lot.absent[own], lot.id[own])
        scored, at = scored + len(own), upto
    return scored


def _ranked(found: DataFrame, words: Vocabulary, weight: np.ndarray, documents: int, total: int, first: int, k: int) -> DataFrame:
    """item (its number), absent, id and score of each task's best documents."""
    size, items = len(words.hash), words.items
    width = max(64, CELLS // max(1, size))

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lists, held, rows = [Best(k) for _ in items], [], 0

        def work(frame: pd.DataFrame) -> None:
            lot = Lot(frame, size, documents, total)
            for item, best in zip(items, lists):
                if len(item):
                    search_lot(lot, item, weight[item], best)

        for batch in batches:
            for at in range(0, len(batch), width):
                part = batch.iloc[at:at + width]
                if rows + len(part) > width:
                    work(pd.concat(held, ignore_index=True))
                    held, rows = [], 0
                held.append(part)
                rows += len(part)
        if held:
            work(pd.concat(held, ignore_index=True))
        for number, best in enumerate(lists):
            if len(best.id):
                yield pd.DataFrame({"item": first + number, "absent": best.absent, "id": best.id, "score": best.score})

    return found.mapInPandas(run, "item long, absent boolean, id long, score long")


def _item_blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int | None, list[str]]]]:
    """Items (id, distinct terms) in blocks of bounded size."""
    low = F.translate(F.coalesce(F.col(text), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = F.array_distinct(F.array_remove(F.split(low, SEPARATORS), ""))
    held, size = [], 0
    for row in items.select(F.col(item_id).cast("long").alias("id"), terms.alias("terms")).toLocalIterator():
        own = 64 + sum(len(t) + 8 for t in row.terms)
        if held and size + own > ITEMS_BYTES:
            yield held
            held, size = [], 0
        held.append((row.id, row.terms))
        size += own
    if held:
        yield held


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           query: str = "text", k: int = BEST) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of each item's best ``k`` documents."""
    spark, folder = ship(docs.sparkSession), work_folder(docs.sparkSession, "ranked-search")
    out, number = None, 0
    for block in _item_blocks(items, item_id, query):
        words = Vocabulary([terms for _, terms in block])
        path = f"{folder}/postings-{number}"
        postings(docs, words.hash, doc_id, text).write.parquet(path)
        found = spark.read.parquet(path)
        documents, total = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("terms"), F.lit(0))).first()
        weight = weights(documents, frequencies(found, len(words.hash)))
        names = spark.createDataFrame([(number + i, own) for i, (own, _) in enumerate(block)], "item long, item_id long")
        lists = _ranked(found.filter(F.length("codes") > 0), words, weight, documents, total, number, k).join(names, "item")
        out, number = lists if out is None else out.unionByName(lists), number + len(block)
    if out is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    by_score = (F.col("score").desc(), "absent", "id")
    part = F.pmod(F.xxhash64("id", "score"), F.lit(SPREAD))
    # Lists of very many tasks are cut in parts first, so no task gets all of an item.
    for keys in (("item", part), ("item",)):
        out = out.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*by_score))).filter(F.col("rank") <= k)
    return out.select("item_id", "rank", F.when(~F.col("absent"), F.col("id")).alias("doc_id"), "score")
