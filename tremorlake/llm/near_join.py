"""N-gram Jaccard join with Bayesian pruning of candidates.

A text is its set of runs of five words (:mod:`textkit`; a text of fewer words is one run). Two texts are linked when the
Jaccard similarity of their sets is at least 0.8.

1. *Classes.* Texts with equal sets form one class; copies go no further than this. A class carries 128 MinHash values, a
   byte each, and 32 band keys of four values each.
2. *Candidates.* Classes with a common band key meet. A pair at 0.8 shares none of the 32 keys with probability
   5e-8, and nothing bounds how many meet.
3. *Pruning.* Pairs compare 16, 32, 64, then 128 MinHash values. With a uniform prior, the posterior probability that the
   similarity reaches the threshold, given m agreements among n, is a binomial tail; a pair below ``TOLERANCE`` is dropped.
4. *Verification.* What stands joins classes to clusters, so every pair worth an exact look lies within a cluster. The sets of
   its texts are compared exactly, in blocks, as products of incidence matrices. Each class gets its number of links, copies
   counted, and links join classes to components.

Pairs are never rows: a meeting of two blocks gives a row per class. Work within one cluster still grows with
the square of its different texts, spread over tasks.

Defined results: a text without words links with nothing and is its own class; texts equal up to case, signs and white space link;
a null ``doc_id`` is larger than any other; rows that repeat ``doc_id`` and text count as copies; an empty table gives an
empty result; other columns, of whatever name, pass through ``one_of_each``. That leaves one row of each class and decides
by id and set, so texts that share an id, or have none, stand or go each by themselves.
"""

from collections.abc import Callable, Iterable, Iterator
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorlake.llm import linking, prefilter
from tremorlake.llm.shipping import ship
from tremorlake.llm.textkit import Words, as_bytes, mix, seeds, slices
from tremorlake.session import work_folder

NGRAM = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 4
LOOKS = (16, 32, 64, 128)
TOLERANCE = 1e-6
#: Classes of a block where sketches are compared, and where whole sets are.
LOOK_BLOCK, VERIFY_BLOCK = 2048, 256

_FACTORS = (seeds("minhash", BANDS * ROWS) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_MASKS = (seeds("masks", BANDS * ROWS) >> np.uint64(32)).astype(np.uint32)


def needed(n: int, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> int:
    """The fewest agreements among n values that leave a pair worth looking at.

    Bytes of unlike values agree once in 256. With a uniform prior, the chance of a similarity of at
    least t after m of n agreements is that of at most m successes in n + 1 trials with probability t.
    """
    t, below = threshold + (1 - threshold) / 256, 0.0
    for m in range(n + 1):
        below += comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
        if below >= tolerance:
            return m
    return n


def shingle_sets(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """For lots of texts: the distinct sorted shingles of all, where each text's begin, and the number of texts."""
    for part in slices(texts):
        hashes, doc = Words(part).ngrams(NGRAM)
        order = np.lexsort((hashes, doc))
        hashes, doc = hashes[order], doc[order]
        new = np.ones(len(hashes), dtype=bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
        hashes, doc = hashes[new], doc[new]
        yield hashes, np.searchsorted(doc, np.arange(len(part) + 1)), len(part)


def nodes(hashes: np.ndarray, begin: np.ndarray) -> list[str | None]:
    """A 128-bit name for each set, in hexadecimal; None for an empty one."""
    size = np.diff(begin)
    out = []
    for salt in (0x51, 0xA7):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes + np.uint64(salt)), dtype=np.uint64)])
        out.append(mix(total[begin[1:]] - total[begin[:-1]] + size.astype(np.uint64)))
    return [f"{a:016x}{b:016x}" if n else None for a, b, n in zip(out[0].tolist(), out[1].tolist(), size.tolist())]


def signatures(hashes: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of MinHash values and band keys of the sets that aren't empty."""
    full = np.flatnonzero(np.diff(begin))
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    values = np.empty((len(full), BANDS * ROWS), dtype=np.uint32)
    for k in range(BANDS * ROWS):
        values[:, k] = np.minimum.reduceat((x ^ _MASKS[k]) * _FACTORS[k], begin[full])
    keys = np.empty((len(full), BANDS), dtype=np.uint64)
    for band in range(BANDS):
        key = np.full(len(full), band, dtype=np.uint64)
        for k in range(band * ROWS, (band + 1) * ROWS):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + values[:, k] + np.uint64(1))
        keys[:, band] = key
    return (mix(values.astype(np.uint64)) & np.uint64(255)).astype(np.uint8), keys.view(np.int64)


def _named(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, node, MinHash bytes and band keys of each row."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, at = batch.doc_id.to_numpy(), 0
            for hashes, begin, n in shingle_sets(as_bytes(batch.text)):
                names = nodes(hashes, begin)
                values, keys = signatures(hashes, begin) if len(hashes) else ([], [])
                values, keys = iter(values), iter(keys)
                yield pd.DataFrame({
                    "doc_id": ids[at:at + n], "node": names,
                    "sketch": [next(values).tobytes() if name else None for name in names],
                    "bands": [next(keys) if name else None for name in names]})
                at += n

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInPandas(run, "doc_id long, node string, sketch binary, bands array<long>")


def _candidates(classes: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Edges (a, b) that join all classes between which a pair survives the pruning."""
    least = [needed(n, threshold, tolerance) for n in LOOKS]

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in linking.whole_groups(batches):
            sketch = np.frombuffer(b"".join(frame.sketch), dtype=np.uint8).reshape(len(frame), BANDS * ROWS)
            found = []
            for i, j in linking.pairs_of(frame):
                agree, seen = np.zeros(len(i), dtype=np.int64), 0
                for n, fewest in zip(LOOKS, least):
                    agree += (sketch[i, seen:n] == sketch[j, seen:n]).sum(axis=1)
                    stay, seen = agree >= fewest, n
                    i, j, agree = i[stay], j[stay], agree[stay]
                found.append((i, j))
            i = np.concatenate([x for x, _ in found] or [np.zeros(0, dtype=np.int64)])
            j = np.concatenate([x for _, x in found] or [np.zeros(0, dtype=np.int64)])
            root, node = linking.forest(len(frame), i, j), frame.node.to_numpy()
            linked = np.flatnonzero(root != np.arange(len(root)))
            if len(linked):
                yield pd.DataFrame({"a": node[linked], "b": node[root[linked]]}).drop_duplicates()

    keys = classes.select("node", F.explode("bands").alias("group"))
    met = linking.meetings(keys, BANDS * classes.count(), block=LOOK_BLOCK).join(classes.select(F.col("node").alias("__n"), "sketch"), F.col("node") == F.col("__n"))
    return linking.dealt(met.select("meeting", "side", "alone", "node", "sketch")).mapInPandas(run, "a string, b string")


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets."""
    flat = np.concatenate(sets)
    of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times[column] > 1
    of, column = of[shared], np.unique(column[shared], return_inverse=True)[1]
    out = np.diag([float(len(s)) for s in sets])
    np.fill_diagonal(out, 0)
    order = np.argsort(column, kind="stable")
    of, column = of[order], column[order]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):  # so many columns at once
        a, b = np.searchsorted(column, [low, low + 4096])
        part = np.zeros((len(sets), 4096), dtype=np.float32)
        part[of[a:b], column[a:b] - low] = 1
        out += part @ part.T
    return out


def _verified(members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """node, links (copies counted) and root for each class and meeting with a link, of members (group, node, copies) with sets."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in linking.whole_groups(batches):
            for begin, n in zip(*linking.groups_of(frame)):
                part = frame.iloc[begin:begin + n]
                sets = [np.frombuffer(s, dtype=np.uint64) for s in part.shingles]
                both = _overlaps(sets)
                size = np.array([len(s) for s in sets], dtype=np.float64)
                linked = both >= threshold * (size[:, None] + size[None, :] - both) - 1e-9
                np.fill_diagonal(linked, False)
                if not part.alone.iloc[0]:
                    side = part.side.to_numpy()
                    linked &= side[:, None] != side[None, :]
                links = linked @ part.copies.to_numpy()
                root = linking.forest(n, *np.nonzero(np.triu(linked)))
                some, node = np.flatnonzero(links), part.node.to_numpy()
                if len(some):
                    yield pd.DataFrame({"node": node[some], "links": links[some], "root": node[root[some]]})

    met = linking.meetings(members, members.count(), block=VERIFY_BLOCK).join(sets, "node")
    return linking.dealt(met.select("meeting", "side", "alone", "node", "copies", "shingles")).mapInPandas(run, "node string, links long, root string")


def _sets(docs: DataFrame, doc_id: str, text: str, wanted: DataFrame) -> DataFrame:
    """node and shingles of the classes named in ``wanted`` (node, first_id)."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for hashes, begin, _ in shingle_sets(as_bytes(batch.text)):
                names = nodes(hashes, begin)
                yield pd.DataFrame({"node": names, "shingles": [
                    hashes[a:b].tobytes() for a, b in zip(begin[:-1], begin[1:])]}).dropna()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    ids = wanted.select("first_id").distinct()
    may, _ = prefilter.split(rows, F.col("doc_id"), ids)
    # What is left is shuffled at any size: the plan that holds when ids are too many to send to every task.
    own = may.hint("merge").join(ids, may.doc_id.eqNullSafe(ids.first_id), "left_semi").select("text")
    found = own.mapInPandas(run, "node string, shingles binary")
    return found.groupBy("node").agg(F.first("shingles").alias("shingles"))


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
         tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, class_id (smallest doc_id reachable over links), n_links (other rows linked directly) and kept."""
    rows, named, stored = _named_classes(docs, doc_id, text, threshold, tolerance)
    smallest = named.groupBy(F.col("root").alias("__root")).agg(F.min("first_id").alias("class_id"))
    decided = stored(linking.looked_up(named, "root", smallest, named.count()).select(
        "node", "class_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        (F.col("first_id").eqNullSafe(F.col("class_id"))).alias("first")), "decided")
    out = rows.select("doc_id", "node").join(decided, "node", "left")
    return out.select(
        "doc_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        (F.col("node").isNull() | (F.col("first") & F.col("doc_id").eqNullSafe(F.col("class_id")))).alias("kept"))


def _named_classes(docs: DataFrame, doc_id: str, text: str, threshold: float,
                   tolerance: float) -> tuple[DataFrame, DataFrame, Callable[[DataFrame, str], DataFrame]]:
    """Rows (doc_id, node); their classes with copies, first_id, links to others and root; and what stores a table."""
    spark, folder = ship(docs.sparkSession), work_folder(docs.sparkSession, "near-join")

    def stored(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    rows = stored(_named(docs, doc_id, text), "rows")
    classes = stored(rows.filter("node IS NOT NULL").groupBy("node").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_id"),
        F.first("sketch").alias("sketch"), F.first("bands").alias("bands")), "classes")
    clusters = linking.components(_candidates(classes, threshold, tolerance), f"{folder}/candidates")
    clusters = stored(clusters.join(classes.select("node", "copies", "first_id"), "node"), "clusters")
    members = clusters.select(F.col("root").alias("group"), "node", "copies")
    linked = stored(_verified(members, _sets(docs, doc_id, text, clusters), threshold), "linked")
    links = linked.groupBy("node").agg(F.sum("links").alias("links"))
    found = linking.components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")), f"{folder}/links")
    named = classes.select("node", "copies", "first_id").join(found, "node", "left").join(links, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    return rows, stored(named, "named"), stored


def _key(doc_id: Column, node: Column) -> Column:
    return F.concat_ws(" ", F.coalesce(doc_id.cast("string"), F.lit("none")), node)


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
                tolerance: float = TOLERANCE) -> DataFrame:
    """One row of each class of ``docs``, with its columns: the smallest id, of texts that share it or have none the smallest node."""
    rows, named, stored = _named_classes(docs, doc_id, text, threshold, tolerance)
    groups = named.filter("copies > 1 OR links IS NOT NULL")
    first = groups.groupBy("root").agg(F.min(F.struct(F.col("first_id").isNull(), "first_id", "node")).alias("one")).select(
        F.col("one.node").alias("__first"))
    stays = F.col("__first").isNotNull() & F.col("doc_id").eqNullSafe(F.col("first_id"))
    # Stored, so that rows of a set with very many copies can be dealt anew where they join it.
    firsts = stored(groups.select("node", "first_id").join(first, F.col("node") == F.col("__first"), "left"), "firsts")
    members = rows.select("doc_id", "node").join(firsts, "node")
    # Rows that go, and rows that stand for a class but repeat both id and set.
    marks = stored(members.select("doc_id", "node", stays.alias("stays")).groupBy("doc_id", "node", "stays").count().filter(
        "NOT stays OR count > 1").select("doc_id", _key(F.col("doc_id"), F.col("node")).alias("__gone"), "stays"), "marks")
    gone = marks.filter("NOT stays").select("__gone")
    # The whole row lies in one column, so no name of its own can clash with one of these.
    whole = docs.select(F.struct("*").alias("row"), F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    may, stay = prefilter.split(whole, F.col("id"), marks.select("doc_id").distinct())

    @F.pandas_udf("string")
    def node_of(texts: pd.Series) -> pd.Series:
        names = [nodes(hashes, begin) for hashes, begin, _ in shingle_sets(as_bytes(texts))]
        return pd.Series([name for part in names for name in part], dtype=object)

    # Texts without words have no node: a key of their own each.
    own = F.concat(F.lit("row "), F.monotonically_increasing_id().cast("string"))
    may = may.withColumn("node", node_of(F.col("text"))).withColumn("__key", F.when(
        F.col("node").isNull(), own).otherwise(_key(F.col("id"), F.col("node"))))
    # Repeats leave inside map tasks, before the shuffle.
    left = may.dropDuplicates(["__key"]).hint("merge").join(gone, F.col("__key") == F.col("__gone"), "left_anti")
    return stay.select("row.*").unionByName(left.select("row.*"))
