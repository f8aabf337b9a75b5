"""Embedding near-dedup with randomised-rotation binary codes.

Each vector is made a unit vector, turned by a fixed random rotation and kept as one sign bit per dimension, with a
correction factor: the inner product of the turned vector with its own signs. With them the inner product with any other
vector is estimated without bias, and the estimate's error has a known spread, so a pair whose upper confidence bound lies
below the threshold is dropped and every other pair is computed exactly, in double precision.

1. *Equal vectors* of one label form a node and count as copies.
2. *Candidates.* Signs of further random projections give ``tables`` keys of ``bits`` bits. Bits grow with the logarithm of
   the largest label and ``SPARE`` bits leave most keys to one vector, which is then not dealt: chance meetings grow with the
   rows only, and are few. Tables follow from ``MISS``, the chance that a pair exactly at the threshold shares no key. (A pair
   at 0.99 is missed a thousand times less.) No number of partners or bucket size is capped: large buckets meet block by block.
3. *Links.* A pair counts in the first table in which it meets. A meeting of two blocks gives a row per node, never per pair.
4. *Components* of the links.

Defined results: vectors of unequal length never link; vectors that are null, zero, empty or hold null or non-finite components, or
whose label is null, link with nothing; a null ``vec_id`` is larger than any other; rows that repeat a vec_id count as
vectors of their own; an empty table gives an empty result; other columns are not read.
"""

from collections.abc import Iterable, Iterator
from functools import lru_cache
from math import acos, ceil, log, log2, pi, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from tremorlake.llm import linking
from tremorlake.llm.shipping import ship
from tremorlake.llm.textkit import mix
from tremorlake.session import work_folder

THRESHOLD = 0.98
#: Chance that a pair at the threshold meets in no table.
MISS = 1e-5
#: Standard deviations of the estimate's error that a pair is given before it is dropped.
CONFIDENCE = 6.0
SEED = 20_240_501
#: Bits of a key beyond those that give each vector of the largest label a key of its own on average.
SPARE = 2
#: Nodes of a block.
BLOCK = 1024


@lru_cache(maxsize=8)
def rotation(dimensions: int) -> np.ndarray:
    """A fixed random rotation."""
    q, r = np.linalg.qr(np.random.default_rng(SEED + dimensions).normal(size=(dimensions, dimensions)))
    return q * np.sign(np.diag(r))


@lru_cache(maxsize=8)
def _projections(dimensions: int, count: int) -> np.ndarray:
    return np.random.default_rng(SEED - dimensions).normal(size=(dimensions, count))


def codes(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign bits of turned unit vectors, packed, and their correction factors."""
    turned = unit @ rotation(unit.shape[1])
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / sqrt(unit.shape[1])


def estimates(signs: np.ndarray, factor: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of coded unit vectors with turned ones, row by row, and one standard deviation of the error."""
    d = turned.shape[1]
    coded = (np.unpackbits(signs, axis=1, count=d).astype(np.float32) * 2 - 1) / np.float32(sqrt(d))
    spread = np.sqrt(np.maximum(0, 1 - factor ** 2)) / factor / sqrt(max(1, d - 1))
    return (coded * turned).sum(axis=1) / factor, spread


def layout(largest: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """Tables and bits of a key for labels of up to ``largest`` rows."""
    same = 1 - acos(threshold) / pi
    bits = min(32, max(8, ceil(log2(max(2, largest))) + SPARE))
    return ceil(log(miss) / log(1 - same ** bits)), bits


def _usable(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """vec_id and node, null for vectors that can't link, with the vector and label."""
    v = F.col("v")
    sound = (F.col("label").isNotNull() & v.isNotNull()
             & F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
             & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False)))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"),
                          F.col(embedding).cast("array<double>").alias("v"))
    name = F.md5(F.to_json(F.struct("label", F.transform("v", lambda x: x + 0.0).alias("v"))))  # no label reads like a number
    return rows.withColumn("node", F.when(sound, name))


def _precision(vectors: DataFrame, embedding: str) -> str:
    """How the numbers of a vector are kept: in single precision where they are of that type, which loses nothing."""
    kind = getattr(vectors.select(embedding).schema[0].dataType, "elementType", None)
    return "<f4" if isinstance(kind, FloatType) else "<f8"


def _units(raw: np.ndarray) -> np.ndarray:
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def _keyed(nodes: DataFrame, tables: int, bits: int, precision: str) -> DataFrame:
    """Nodes with a key per table, the sides of the projections that these are made of, code, correction factor and vector."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lengths = batch.v.map(len).to_numpy()
            for d in np.unique(lengths):
                part = batch[lengths == d]
                raw = np.stack(part.v.to_numpy()).astype(np.float64)
                unit = _units(raw)
                side = (unit @ _projections(int(d), tables * bits) > 0).reshape(len(part), tables, bits)
                sides = (side * (np.uint64(1) << np.arange(bits, dtype=np.uint64))).sum(axis=2, dtype=np.uint64)
                salt = pd.util.hash_array(part.label.to_numpy(dtype=object)).astype(np.uint64)[:, None]
                key = mix(mix(sides + salt) + np.arange(tables, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(d))
                bit, factor = codes(unit)
                yield pd.DataFrame({
                    "node": part.node, "keys": list(key.view(np.int64)), "sides": [x.tobytes() for x in sides.astype("<u4")],
                    "code": [b.tobytes() for b in bit], "factor": factor, "copies": part.copies,
                    "vector": [x.tobytes() for x in raw.astype(precision)]})

    return nodes.mapInPandas(
        run, "node string, keys array<long>, sides binary, code binary, factor double, copies long, vector binary")


def _links(keyed: DataFrame, tables: int, precision: str, threshold: float, confidence: float) -> DataFrame:
    """node, links (copies counted) and root for each node and meeting with a link."""

    def compare(frame: pd.DataFrame) -> pd.DataFrame | None:
        unit = _units(np.frombuffer(b"".join(frame.vector), dtype=precision).reshape(len(frame), -1).astype(np.float64))
        d = unit.shape[1]
        turned = (unit @ rotation(d)).astype(np.float32)
        signs = np.frombuffer(b"".join(frame.code), dtype=np.uint8).reshape(len(frame), -1)
        factor, table = frame.factor.to_numpy(), frame.table.to_numpy()
        sides = np.frombuffer(b"".join(frame.sides), dtype="<u4").reshape(len(frame), tables)
        copies, node = frame.copies.to_numpy(), frame.node.to_numpy()
        links, ends = np.zeros(len(frame), dtype=np.int64), []
        earlier = np.arange(tables)[None, :]
        for i, j in linking.pairs_of(frame, 1 << 17):
            guess, spread = estimates(signs[i], factor[i], turned[j])
            near = np.flatnonzero(guess + confidence * spread >= threshold)
            i, j = i[near], j[near]
            exact = np.flatnonzero((unit[i] * unit[j]).sum(axis=1) >= threshold)
            i, j = i[exact], j[exact]
            first = np.flatnonzero(~((sides[i] == sides[j]) & (earlier < table[i][:, None])).any(axis=1))
            i, j = i[first], j[first]
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            ends.append((i, j))
        i = np.concatenate([x for x, _ in ends] or [np.zeros(0, dtype=np.int64)])
        j = np.concatenate([x for _, x in ends] or [np.zeros(0, dtype=np.int64)])
        root, some = linking.forest(len(frame), i, j), np.flatnonzero(links)
        return pd.DataFrame({"node": node[some], "links": links[some], "root": node[root[some]]}) if len(some) else None

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in linking.whole_groups(batches):
            lengths = frame.vector.map(len).to_numpy()
            for d in np.unique(lengths):  # all of a meeting have one length
                found = compare(frame[lengths == d].reset_index(drop=True))
                if found is not None:
                    yield found

    keys = keyed.select("node", F.posexplode("keys").alias("table", "group"))
    met = linking.meetings(keys, tables * keyed.count(), block=BLOCK).join(
        keyed.drop("keys").withColumnRenamed("node", "__n"), F.col("node") == F.col("__n"))
    rows = met.select("meeting", "side", "alone", "table", "node", "sides", "code", "factor", "copies", "vector")
    return linking.dealt(rows).mapInPandas(run, "node string, links long, root string")


def dedup(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
          threshold: float = THRESHOLD, miss: float = MISS, confidence: float = CONFIDENCE) -> DataFrame:
    """vec_id, n_links (other vectors linked directly), component_id and kept for every vector."""
    spark, folder = ship(vectors.sparkSession), work_folder(vectors.sparkSession, "vector-dedup")

    def stored(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    rows = _usable(vectors, vec_id, embedding, label)
    nodes = stored(rows.filter("node IS NOT NULL").groupBy("node").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first_id"), F.first("v").alias("v"),
        F.first("label").alias("label")), "nodes")
    largest = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    tables, bits = layout(largest, threshold, miss)
    precision = _precision(vectors, embedding)
    keyed = stored(_keyed(nodes, tables, bits, precision), "keyed")
    linked = stored(_links(keyed, tables, precision, threshold, confidence), "linked")
    links = linked.groupBy("node").agg(F.sum("links").alias("links"))
    found = linking.components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")), f"{folder}/links")
    named = nodes.select("node", "copies", "first_id").join(found, "node", "left").join(links, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    named = stored(named, "named")
    smallest = named.groupBy(F.col("root").alias("__root")).agg(F.min("first_id").alias("component_id"))
    decided = stored(linking.looked_up(named, "root", smallest, named.count()).select(
        "node", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "decided")
    out = rows.select("vec_id", "node").join(decided, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
