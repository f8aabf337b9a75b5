"""Merkle dataset manifest by a butterfly exchange.

Every row is a leaf, the SHA-256 of its fields. The leaves of a group, in order, are hashed together two by two, level by level,
up to a subroot; the subroots, in the order of their groups, likewise up to the root. Each leaf gets its proof: what stands beside
it on every level.

1. *Places.* Leaves are dealt by ranges of (group, order, leaf) and numbered within their group from the row counts of the ranges.
   A row's text is hashed where it is read; what is shuffled is its digest.
2. *Blocks.* ``BLOCK`` leaves from a multiple of ``BLOCK`` on are a partition of the tree: one hash tree of their own, whose root
   is a node of the group's tree.
3. *Butterfly.* In round r the partitions whose numbers agree but for digit r (in base ``FANOUT``) form a group of ``FANOUT``. They swap the
   roots they hold, and each hashes the levels above for itself. After a round, all partitions below one ancestor
   hold the same root, and each the siblings on its own way up, so after the last round each has its upper proof and nothing is handed
   down. Where the last run of partitions is short, its members stand in for the missing ones.
4. *Subroots* go through the same steps as the leaves of one last tree.

A task sees ``BLOCK`` leaves or ``FANOUT`` roots at a time; the driver sees one number a tree.

Defined results: a null field counts as ``-``; a null group comes first and is a group of its own; null ids come first; rows that repeat an id
follow one another by their digests; equal rows are leaves of their own, with proofs of their own; a table of one row has its
leaf as root and an empty proof; an empty table gives an empty result; other columns are not read.
"""

from collections.abc import Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremorlake.llm.shipping import ship
from tremorlake.session import work_folder

#: Leaves of a block: two to the power of ``BLOCK_LEVELS``.
BLOCK_LEVELS = 10
#: Partitions that swap roots in a round: two to the power of ``FANOUT_LEVELS``.
FANOUT_LEVELS = 4

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: On each level of a path: the sibling's side and digest, or nothing for a node that stands alone.
_LEFT, _RIGHT = "l", "r"


def leaf(fields: Sequence[Column]) -> Column:
    """The digest of a row's fields: of each its count of UTF-8 bytes, ``:`` and value, or ``-`` if null."""
    def written(field: Column) -> Column:
        value = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(written, fields)), 256)


def climb(nodes: list[str], count: int, levels: int) -> list[list[str]]:
    """The levels above some neighbouring nodes, from the nodes themselves, up to ``levels`` more.

    ``count`` nodes stand on their level in the whole tree, which ends where one is left.
    """
    out = [nodes]
    for _ in range(levels):
        if count <= 1:
            break
        nodes = [sha256("".join(nodes[i:i + 2]).encode()).hexdigest() for i in range(0, len(nodes), 2)]
        out.append(nodes)
        count = (count + 1) // 2
    return out


def siblings(levels: list[list[str]], place: int) -> list[str]:
    """What stands beside a node's ancestors on each of :func:`climb`'s levels but the last."""
    path = []
    for nodes in levels[:-1]:
        other = place ^ 1
        path.append("" if other >= len(nodes) else (_LEFT if other < place else _RIGHT) + nodes[other])
        place >>= 1
    return path


def _placed(leaves: DataFrame, folder: str) -> DataFrame:
    """``leaves`` (grp, ord, leaf, name, claimed) with place and total, their number in their group and the group's size."""
    # Equal rows are interchangeable, so a row number may split them between ranges.
    keys = ("grp", "ord", "leaf", "salt")
    (leaves.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("salt")
     .withColumn("at", F.monotonically_increasing_id()).write.parquet(f"{folder}/ranges"))
    # The high bits of such a number are the range, the low ones count its rows.
    rows = leaves.sparkSession.read.parquet(f"{folder}/ranges").withColumn("part", F.shiftright("at", 33))
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = rows.groupBy("grp", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).select(
        "grp", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(Window.partitionBy("grp")).alias("total"))
    return rows.join(runs, ["grp", "part"]).select(
        "grp", "leaf", "name", "claimed", "total", (F.col("at") + F.col("shift")).alias("place"))


def _block_roots(placed: DataFrame, block_levels: int) -> DataFrame:
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("place")
        top = climb(frame.leaf.tolist(), int(frame.total.iloc[0]), block_levels)[-1]
        return pd.DataFrame({"grp": frame.grp.iloc[:1], "block": frame.block.iloc[:1], "total": frame.total.iloc[:1], "node": top})

    found = placed.select("grp", "place", "total", "leaf", F.shiftright("place", block_levels).alias("block")).groupBy(
        "grp", "block").applyInPandas(run, "grp string, block long, total long, node string")
    blocks = F.shiftright(F.col("total") + ((1 << block_levels) - 1), block_levels)
    return found.select("grp", "block", blocks.alias("blocks"), "node", F.array().cast("array<string>").alias("path"))


def swap(held: DataFrame, turn: int, fanout_levels: int = FANOUT_LEVELS) -> DataFrame:
    """One round: partitions (grp, block, blocks, node, path) with the node ``fanout_levels`` further up and the way there."""
    fanout = 1 << fanout_levels
    step = fanout ** turn  # partitions below one node
    side, seat = F.floor(F.col("block") / step).cast("long"), F.col("block") % step
    members = F.least(F.lit(step).cast("long"), F.col("blocks") - F.col("side") * step)
    stands_in = (F.col("members") < step) & (F.col("side") % fanout != 0)
    seats = F.when(stands_in, F.expr(f"sequence(seat, {step - 1}L, members)")).otherwise(F.array("seat"))
    open_ones = held.filter(F.col("blocks") > step).withColumns({"side": side, "seat": seat}).withColumn("members", members)
    sent = open_ones.withColumn("at", F.explode(seats)).withColumn("ring", F.floor(F.col("side") / fanout).cast("long"))
    met = Window.partitionBy("grp", "ring", "at")
    swapped = sent.withColumn("met", F.sort_array(F.collect_list(F.struct("side", "node")).over(met))).filter("at = seat")
    count = F.ceil(F.col("blocks") / step).cast("long")

    @F.pandas_udf("node string, path array<string>")
    def ancestors(nodes: pd.Series, place: pd.Series, count: pd.Series) -> pd.DataFrame:
        """The node above swapped roots, and the siblings on the way there from the one at a place."""
        found = []
        for several, own, n in zip(nodes, place, count):
            levels = climb(list(several), int(n), fanout_levels)
            found.append((levels[-1][0], siblings(levels, int(own))))
        return pd.DataFrame(found, columns=["node", "path"])

    risen = swapped.withColumn("up", ancestors(F.col("met.node"), F.col("side") % fanout, count))
    return risen.select("grp", "block", "blocks", F.col("up.node").alias("node"), F.concat("path", "up.path").alias("path")).unionByName(
        held.filter(F.col("blocks") <= step))


def _proved(leaves: DataFrame, folder: str, block_levels: int, fanout_levels: int) -> tuple[DataFrame, DataFrame]:
    """Placed leaves; and the partitions with root and upper path."""
    spark = leaves.sparkSession

    def stored(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    placed = _placed(leaves, folder)
    held = stored(_block_roots(placed, block_levels), "round-0")
    most, turn = held.agg(F.max("blocks")).first()[0] or 0, 0
    while 1 << (fanout_levels * turn) < most:
        held = stored(swap(held, turn, fanout_levels), f"round-{turn + 1}")
        turn += 1
    return placed, held


def _expanded(placed: DataFrame, held: DataFrame, block_levels: int) -> DataFrame:
    """name, leaf, claimed and the whole path of every leaf, with the ``subroot`` and ``root`` that ``held`` brings."""
    def run(own: pd.DataFrame, upper: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("place")
        levels = climb(own.leaf.tolist(), int(own.total.iloc[0]), block_levels)
        above = list(upper.path.iloc[0])
        return pd.DataFrame({
            "grp": own.grp, "name": own.name_, "leaf": own.leaf, "claimed": own.claimed, "subroot": upper.subroot.iloc[0],
            "root": upper.root.iloc[0], "path": [siblings(levels, k) + above for k in range(len(own))]})

    blocks = placed.withColumnRenamed("name", "name_").withColumn("block", F.shiftright("place", block_levels))
    return blocks.groupBy("grp", "block").cogroup(held.groupBy("grp", "block")).applyInPandas(
        run, "grp string, name string, leaf string, claimed string, subroot string, root string, path array<string>")


def manifest(docs: DataFrame, doc_id: str = "doc_id", group: str = "lang", fields: Sequence[str] = FIELDS,
             claimed: Column | None = None, block_levels: int = BLOCK_LEVELS, fanout_levels: int = FANOUT_LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root and path (siblings from the leaf up, each with its side) for every row.

    ``claimed`` is the leaf by which a reader knows the row, for :func:`folded`; by default the row's own.
    """
    spark, folder = ship(docs.sparkSession), work_folder(docs.sparkSession, "merkle")
    own = leaf([F.col(f) for f in fields])
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("grp"),  # a null sorts before the empty text
        F.col(doc_id).alias("ord"), own.alias("leaf"), F.col(doc_id).cast("string").alias("name"),
        (own if claimed is None else claimed).alias("claimed"))
    placed, held = _proved(rows, f"{folder}/leaves", block_levels, fanout_levels)
    subroots = held.filter("block = 0").select(
        F.lit("").alias("grp"), F.col("grp").alias("ord"), F.col("node").alias("leaf"), F.col("grp").alias("name"), F.col("node").alias("claimed"))
    top_placed, top_held = _proved(subroots, f"{folder}/subroots", block_levels, fanout_levels)
    tops = _expanded(top_placed, top_held.select("grp", "block", "path", F.col("node").alias("subroot"), F.col("node").alias("root")), block_levels).select(
        F.col("name").alias("grp"), "root", F.col("path").alias("top_path"))
    whole = held.join(tops, "grp").select("grp", "block", F.col("node").alias("subroot"), "root", F.concat("path", "top_path").alias("path"))
    return _expanded(placed, whole, block_levels).select(
        F.col("name").cast(docs.schema[doc_id].dataType).alias("doc_id"), "leaf", "claimed", "subroot", "root", "path")


def proof_digest(path: Column) -> Column:
    """The digest of a path's siblings, from the leaf up."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.substring(s, 2, 64)), ""), 256)


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    def up(node: Column, s: Column) -> Column:
        other = F.substring(s, 2, 64)
        return F.sha2(F.when(F.startswith(s, F.lit(_LEFT)), F.concat(other, node)).otherwise(F.concat(node, other)), 256)

    return F.aggregate(path, start, up)
