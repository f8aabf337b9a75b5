"""Document fingerprints by one-permutation MinHash, and how alike neighbouring documents and edited texts are by them.

A text is its set of runs of five words (:mod:`textkit`; one of fewer words is one run, one without words is one run of its bytes).

1. *Bins.* Each run is hashed once; the high bits of the hash choose one of ``BINS`` bins, which keeps its least hash.
2. *Densification.* An empty bin takes the value of the first bin in its own random order that isn't empty. Each such order is a
   permutation drawn once for all texts, so the loan comes from every full bin with the same chance, independently of the others.
3. *Packing.* Of every bin the low ``BITS`` bits of its (scrambled) hash are stored, two bins a byte, as hexadecimal text.
4. *Likeness.* Bins of unlike values agree once in 2^BITS, so the share of equal bins is corrected for that and kept within 0 and 1.

:func:`neighbours` compares each document with the next by doc_id and with an edited text that ends in the next one's beginning.
Ids alone are dealt by ranges first, which gives the borders; then every text goes once to the task of its range, with the first of
a range also to the task before. Rows that repeat a document are counted where they are read, a batch at a time, and travel once.

Defined results: a null text counts as empty; a null doc_id comes after all others; rows that share an id follow one another by a hash
of their texts; rows that repeat both id and text are one document, whose answer each of them gets; the last document's next is the first, which in a
table of one document is itself; an empty table gives an empty result; other columns are not read.
"""

from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorlake.llm.shipping import ship
from tremorlake.llm.textkit import SLICE, Words, mix, seeds, slices

NGRAM = 5
#: Both powers of two; ``BITS`` divides 8.
BINS, BITS = 512, 4
#: Bytes of text in a range, on average; there are no fewer ranges than shuffle partitions.
RANGE_BYTES = 64 << 20
_SALT = seeds("bytes", 1)[0]


@lru_cache(maxsize=1)
def _loans() -> tuple[np.ndarray, np.ndarray]:
    """Of every bin the order in which it asks the others, and the turn at which it asks each."""
    order = np.argsort(mix(np.arange(BINS * BINS, dtype=np.uint64) + seeds("loans", 1)[0]).reshape(BINS, BINS), axis=1)
    return order, np.argsort(order, axis=1)


def bins(texts: list[bytes]) -> np.ndarray:
    """The least hash in each bin of each text; all ones where a bin is empty."""
    out = np.full((len(texts), BINS), np.iinfo(np.uint64).max, dtype=np.uint64)
    hashes, doc = Words(texts).ngrams(NGRAM)
    bare = np.setdiff1d(np.arange(len(texts)), doc)
    own = [np.uint64(int.from_bytes(sha256(texts[d]).digest()[:8], "big")) for d in bare]
    hashes, doc = np.concatenate([hashes, np.array(own, dtype=np.uint64) ^ _SALT]), np.concatenate([doc, bare])
    shift = np.uint64(64 - BINS.bit_length() + 1)
    np.minimum.at(out.reshape(-1), doc * BINS + (hashes >> shift).astype(np.int64), hashes & ((np.uint64(1) << shift) - np.uint64(1)))
    return out


def densified(values: np.ndarray) -> np.ndarray:
    """``values`` with each empty bin filled by the first full one in its order."""
    empty = values == np.iinfo(np.uint64).max
    order, turn = _loans()
    out, full = values.copy(), (~empty).sum(axis=1)
    few = np.flatnonzero(full <= 24)
    for d in few:
        held = np.flatnonzero(~empty[d])
        lender = held[turn[:, held].argmin(axis=1)]
        out[d] = np.where(empty[d], values[d, lender], values[d])
    many = empty.copy()
    many[few] = False
    row, column = np.nonzero(many)
    for asked in range(BINS):
        if not len(row):
            break
        lender = order[column, asked]
        found = ~empty[row, lender]
        out[row[found], column[found]] = values[row[found], lender[found]]
        row, column = row[~found], column[~found]
    return out


def packed(values: np.ndarray) -> np.ndarray:
    """The low bits of densified values, a row of bytes per text."""
    low = mix(values) & np.uint64((1 << BITS) - 1)
    bits = (low[:, :, None] >> np.arange(BITS - 1, -1, -1, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).reshape(len(values), -1), axis=1)


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """Fingerprints of some texts, as rows of bytes."""
    parts = [packed(densified(bins(part))) for part in slices(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, BINS * BITS // 8), dtype=np.uint8)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of fingerprints, row by row."""
    unequal = np.unpackbits(a ^ b, axis=1).reshape(len(a), BINS, BITS).any(axis=2)
    chance = 2.0 ** -BITS
    return np.clip((1 - unequal.mean(axis=1) - chance) / (1 - chance), 0.0, 1.0)


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter of code points replaced by as many of the following text's first, or all."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def _borders(keyed: DataFrame) -> list[tuple]:
    """The first (absent, id, hash) of each range."""
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # A fixed number, or adaptive execution would merge the ranges of the small keys, and with them those of the texts.
    ranges = max(int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // RANGE_BYTES)
    keys = keyed.select("absent", "id", "hash").repartitionByRange(ranges, "absent", "id", "hash")
    found = keys.groupBy(F.spark_partition_id().alias("part")).agg(F.min(F.struct("absent", "id", "hash")).alias("first"))
    return sorted({tuple(r.first) for r in found.select("first").collect()})


def _dealt(keyed: DataFrame, borders: list[tuple]) -> DataFrame:
    """Distinct rows of a batch with their number (n) and range; the first key's rows also, as guests, in the range before."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            frame = batch.groupby(["absent", "id", "hash", "text"], sort=False).size().rename("n").reset_index()
            keys = list(zip(frame.absent.tolist(), frame.id.tolist(), frame.hash.tolist()))
            frame["range"] = [bisect_right(borders, key) - 1 for key in keys]
            frame["guest"] = False
            first = np.array([borders[r] == key for r, key in zip(frame["range"], keys)], dtype=bool)
            guests = frame[first].assign(guest=True)
            guests["range"] = (guests["range"] - 1) % len(borders)
            yield pd.concat([frame, guests], ignore_index=True)

    shape = "absent boolean, id long, hash long, text string, n long, range int, guest boolean"
    ranges = keyed.mapInPandas(run, shape).repartitionById(max(1, len(borders)), "range")
    return ranges.sortWithinPartitions("range", "guest", "absent", "id", "hash", "text")


def neighbours(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next for every row."""
    ship(docs.sparkSession)
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    keyed = docs.select(F.col(doc_id).isNull().alias("absent"), F.coalesce(F.col(doc_id).cast("long"), F.lit(0)).alias("id"),
                        F.xxhash64(value).alias("hash"), value.alias("text"))

    def answers(chain: list[tuple]) -> pd.DataFrame:
        """For documents (range, absent, id, text, n, guest) in order: all that have their next one behind them."""
        pairs = [(k, k + 1) for k in range(len(chain) - 1) if chain[k][0] == chain[k + 1][0] and not chain[k][-1]]
        after = [edited(chain[a][3], chain[b][3]).encode("utf-8", "surrogatepass") for a, b in pairs]
        marks = fingerprints([d[3].encode("utf-8", "surrogatepass") for d in chain])
        changed = fingerprints(after)
        own, following = ([p[s] for p in pairs] for s in (0, 1))
        frame = pd.DataFrame({
            "absent": [chain[a][1] for a in own], "id": [chain[a][2] for a in own], "n_chars": [len(chain[a][3]) for a in own],
            "edited_sha256": [sha256(t).hexdigest() for t in after], "fingerprint": [marks[a].tobytes().hex() for a in own],
            "edited_fingerprint": [m.tobytes().hex() for m in changed],
            "near_edited": likeness(marks[own], changed), "near_next": likeness(marks[own], marks[following])})
        return frame.loc[np.repeat(np.arange(len(own)), [chain[a][4] for a in own])]

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (row for b in batches for row in zip(b["range"], b.guest, b.absent, b.id, b.text, b.n))
        chain, size = [], 0
        for (at, guest, absent, number, own), same in groupby(rows, key=lambda r: r[:5]):
            chain.append((at, absent, number, own, sum(r[5] for r in same), guest))
            size += len(own)
            if size > SLICE and len(chain) > 1:
                yield answers(chain)
                chain, size = chain[-1:], len(own)
        if len(chain) > 1:
            yield answers(chain)

    found = _dealt(keyed, _borders(keyed)).mapInPandas(
        run, "absent boolean, id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")
    return found.select(F.when(~F.col("absent"), F.col("id")).alias("doc_id"), *found.columns[2:])
