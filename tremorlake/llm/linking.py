"""Pairs within groups without a row per pair, and connected components.

Members of a group are dealt to blocks of bounded size, and every two blocks of a group meet in one task; a task compares
its pairs in numpy and gives at most one row per member. So no group has to fit into a task, no row stands for a pair, and a
group of m members costs m * m / block rows of payload.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fewer keys than this are looked up from a broadcast, however many rows there are.
HUBS = 4096


def looked_up(rows: DataFrame, key: str, found: DataFrame, total: int) -> DataFrame:
    """``rows`` with the columns of ``found``, whose first column holds each key once; null where it lacks a key.

    ``total`` is the number of rows, or more. The keys with over 1 / HUBS of it are fewer than HUBS; they are looked up from a
    broadcast, so no key brings more than that share of the rows into one task. Keys must not be null.
    """
    own, *more = found.columns
    hubs = rows.groupBy(F.col(key).alias("__hub")).agg(F.count(F.lit(1)).alias("__rows")).filter(
        F.col("__rows") > total // HUBS).select("__hub")
    hot = hubs.join(found, F.col("__hub") == F.col(own), "left").select("__hub", *more)
    met = rows.join(F.broadcast(hot), F.col(key) == F.col("__hub")).drop("__hub")
    rest = rows.join(F.broadcast(hubs), F.col(key) == F.col("__hub"), "left_anti")
    return met.unionByName(rest.join(found, F.col(key) == F.col(own), "left").drop(own))


def meetings(members: DataFrame, total: int, group: str = "group", node: str = "node", *, block: int) -> DataFrame:
    """``members`` of groups of two or more, each once for every meeting of its block with a block of its group.

    A block has ``block`` members on average. Adds meeting (its name: group and blocks), side (0 or 1) and alone (True where a
    block meets itself). ``group`` and ``node`` must be unique together; ``total`` is the number of members, or more: sizes of
    the fewer than HUBS groups that hold over 1 / HUBS of it are broadcast.
    """
    sizes = members.groupBy(F.col(group).alias("__group")).agg(F.count(F.lit(1)).alias("__size")).filter("__size > 1")
    large, small = (sizes.filter(F.col("__size") > total // HUBS), sizes.filter(F.col("__size") <= total // HUBS))
    same = F.col(group) == F.col("__group")
    rest = members.join(F.broadcast(large.select("__group")), same, "left_anti")
    found = members.join(F.broadcast(large), same).unionByName(rest.join(small, same))
    blocks = F.ceil(F.col("__size") / block)
    own = F.pmod(F.xxhash64(node, group, F.lit("block")), blocks)
    met = found.withColumns({"__own": own, "__other": F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))})
    return met.withColumns({
        "meeting": F.concat_ws("/", F.col(group).cast("string"), F.least("__own", "__other"), F.greatest("__own", "__other")),
        "side": (F.col("__own") > F.col("__other")).cast("int"),
        "alone": F.col("__own") == F.col("__other"),
    }).drop("__group", "__size", "__own", "__other")


def dealt(met: DataFrame) -> DataFrame:
    """Rows of a meeting side by side in one task."""
    return met.repartition("meeting").sortWithinPartitions("meeting", "side")


def whole_groups(batches: Iterable[pd.DataFrame], column: str = "meeting") -> Iterator[pd.DataFrame]:
    """Sorted batches, cut anew so that no group lies in two of them."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        last = batch[column].iloc[-1]
        begin = int(np.searchsorted((batch[column] == last).to_numpy(), True))
        if begin or held and held[-1][column].iloc[-1] != last:
            yield pd.concat([*held, batch.iloc[:begin]], ignore_index=True)
            held = [batch.iloc[begin:]]
        else:
            held.append(batch)
    if held:
        yield pd.concat(held, ignore_index=True)


def groups_of(frame: pd.DataFrame, column: str = "meeting") -> tuple[np.ndarray, np.ndarray]:
    """First row and size of each group of a sorted frame."""
    value = frame[column].to_numpy()
    first = np.concatenate([[0], np.flatnonzero(value[1:] != value[:-1]) + 1])
    return first, np.diff(np.concatenate([first, [len(value)]]))


def pairs_of(frame: pd.DataFrame, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of all pairs that meet in the groups of a frame, in lots of about ``most``."""
    first, size = groups_of(frame)
    alone, side = frame.alone.to_numpy(), frame.side.to_numpy()
    small = size <= 64
    for n in np.unique(size[small & alone[first]]):
        begins = first[(size == n) & alone[first]]
        i, j = np.triu_indices(int(n), 1)
        step = max(1, most // max(1, len(i)))
        for at in range(0, len(begins) if len(i) else 0, step):
            part = begins[at:at + step, None]
            yield (part + i).ravel(), (part + j).ravel()
    for begin, n in zip(first[~(small & alone[first])], size[~(small & alone[first])]):
        rows = np.arange(begin, begin + n)
        left, right = (rows, rows) if alone[begin] else (rows[side[rows] == 0], rows[side[rows] == 1])
        step = max(1, most // max(1, len(right)))
        for at in range(0, len(left), step):
            i = np.repeat(left[at:at + step], len(right))
            j = np.tile(right, len(left[at:at + step]))
            yield (i[i < j], j[i < j]) if alone[begin] else (i, j)


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest number each of n things reaches over the pairs (i, j)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def components(edges: DataFrame, folder: str, a: str = "a", b: str = "b") -> DataFrame:
    """node and root, the smallest node it reaches, for every node of an edge; by alternating star contractions.

    Edges point from the greater node to the lesser. A round sends each edge to the least node its lesser end points to (itself
    where there is none), then joins the other ends of a node to the least of them. Each half is written to
    ``folder`` and read back, so a lost executor never repeats earlier rounds. Minima are combined in map tasks, and the
    minima of nodes with very many edges are looked up from a broadcast of bounded size.
    """
    spark = edges.sparkSession

    def stored(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    rows = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    past = None
    for turn in range(100):  # the logarithm of the nodes bounds the rounds
        rows = stored(rows, f"stars-{turn}")
        now = tuple(rows.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first())
        if now == past or not now[0]:
            return rows.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                rows.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        past = now
        least = rows.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        large = stored(looked_up(rows, "b", least, now[0]).select("a", F.coalesce("m", "b").alias("b")), f"ends-{turn}")
        lowest = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"), F.max("b").alias("most"))
        several = lowest.filter("m != most").select("u", "m")
        small = looked_up(large, "a", several, now[0]).filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        rows = small.unionByName(lowest.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()
    raise RuntimeError("components did not settle")
