"""Substring dedup by content-defined chunks.

A gear rolling hash over the words of a text, in small letters with one space between, picks the words that begin a
chunk: those at a local minimum of the hash, so borders depend on a few words around them and an insertion shifts none
beyond its neighbourhood. Chunks hold seven words on average. A chunk is known by the digest of its words
(:mod:`textkit`, so case, signs and white space count neither for borders nor for digests). The first occurrence of a digest, by doc_id and place, is the original and always stays.

A run of chunks that follow one another and whose originals do so in one text, of ``SEED_WORDS`` words or more, is the seed of a passage. The
first and last chunks of a repeated passage are cut differently by what surrounds them, so a seed is extended word by word to both
sides for as long as the words agree with those around the originals of its outermost chunks; of these, ``CONTEXT`` words on either
side are looked up. What then holds at least ``LEAST_WORDS`` words is removed; common phrases and lines by themselves are left alone.

Digests are counted with map-side combining; occurrences meet the repeated digests in a plain equi-join, in which
Spark splits a digest that very many texts share. Only a text's own runs are gathered, never a digest's occurrences.

A text that says a few words over and over has no borders of its own; it is cut after every ``gear.LONGEST`` words, so its repeats
may be found in part.

Defined results: null and empty texts stay as they are; rows that repeat both ``doc_id`` and text are one document and
keep or lose the same passages; a null ``doc_id`` comes after all others; of a text that repeats itself, the first
passage stays; an empty table gives an empty result; other columns, of whatever name, pass through.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremorlake.llm import gear, prefilter
from tremorlake.llm.shipping import ship
from tremorlake.llm.textkit import Words, as_bytes, mix, seeds, slices
from tremorlake.session import work_folder

#: Words on either side among which a border has the least hash; the mean chunk holds ``2 * REACH + 1``.
REACH = 3
#: Words a run of repeated chunks must hold to be extended, and words a passage must hold to be removed.
SEED_WORDS, LEAST_WORDS = 6, 50
#: Words beside an original that a run may be extended by, and chunks at either end of a run whose originals are asked.
CONTEXT, EDGES = 40, 2

_ORDER = seeds("chunk", 2)
#: Stands for a null doc_id.
LAST_ID = (1 << 63) - 1


class Chunks:
    """The chunks of some texts: of each the text, the bytes from its first word to the next chunk's, words and digest."""

    def __init__(self, texts: list[bytes], reach: int = REACH):
        words = Words(texts)
        first = gear.word_cuts(*words.stream(), words.doc, reach)
        last = np.concatenate([first[1:], [len(words.start)]]) if len(first) else first
        self.doc = words.doc[first]
        base = words.text_start[self.doc]
        self.begin = words.start[first] - base
        ends = np.concatenate([words.start[first][1:], [0]]) if len(first) else first
        text_end = words.text_start[self.doc] + words.text_bytes[self.doc]
        same = np.concatenate([self.doc[1:] == self.doc[:-1], [False]]) if len(first) else np.zeros(0, dtype=bool)
        self.end = np.where(same, ends, text_end) - base
        self.words = last - first
        #: Numbers, among the words of all texts, of a chunk's first word and of the one behind its last; hash and first byte of each word.
        self.first, self.last, self.hash = first, last, words.hash
        self.start, self.text_words = words.start - words.text_start[words.doc], words.first
        # The digest is a sum over words, each scrambled with its place in the chunk.
        place = np.arange(len(words.hash)) - np.repeat(first, self.words)
        each = mix(words.hash + (place.astype(np.uint64) + np.uint64(1)) * _ORDER[0])
        total = np.concatenate([[np.uint64(0)], np.cumsum(each, dtype=np.uint64)])
        self.digest = mix(total[last] - total[first] + self.words.astype(np.uint64) * _ORDER[1]).view(np.int64)
        self.place = np.arange(len(first)) - np.searchsorted(self.doc, self.doc) if len(first) else first


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)).alias("id"),
                       F.xxhash64(text).alias("text_hash"), F.col(text).cast("string").alias("text"))


def chunks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """id, text_hash, place, words and digest of every chunk of every text."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, hashes, at = batch.id.to_numpy(), batch.text_hash.to_numpy(), 0
            for part in slices(as_bytes(batch.text)):
                c = Chunks(part, reach)
                yield pd.DataFrame({"id": ids[at + c.doc], "text_hash": hashes[at + c.doc],
                                    "place": c.place.astype(np.int32), "words": c.words.astype(np.int32), "digest": c.digest})
                at += len(part)

    ship(docs.sparkSession)
    return _keyed(docs, doc_id, text).mapInPandas(run, "id long, text_hash long, place int, words int, digest long")


def passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", reach: int = REACH,
             seed_words: int = SEED_WORDS) -> DataFrame:
    """Runs of repeated chunks: id, text_hash, first_place, last_place, words, original_ids and edges.

    Edges are the outermost chunks with their originals: side (0 at the beginning, 1 at the end), place, o_id, o_hash, o_place.
    """
    all_chunks = chunks(docs, doc_id, text, reach)
    # An original is ordered by document, then by its place there; one document may be several equal rows.
    known = (all_chunks.groupBy("digest").agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct("id", "text_hash", "place")).alias("original"))
        .filter("times > 1").select(F.col("digest").alias("__digest"), "original"))
    repeated = all_chunks.join(known, F.col("digest") == F.col("__digest")).filter(
        F.struct("id", "text_hash", "place") != F.col("original"))
    own = repeated.groupBy("id", "text_hash").agg(  # a set: rows that repeat a document repeat its chunks
        F.array_sort(F.collect_set(F.struct("place", "words", "original"))).alias("chunks"))

    # Chunks of one passage share the original's text and their distance from it; places that follow one another share the
    # difference between place and rank.
    passage = ("id", "text_hash", "from_id", "from_hash", "away")
    rank = F.row_number().over(Window.partitionBy(*passage).orderBy("chunk.place"))
    ranked = own.select("id", "text_hash", F.explode("chunks").alias("chunk")).select(
        "id", "text_hash", "chunk", F.col("chunk.original.id").alias("from_id"), F.col("chunk.original.text_hash").alias("from_hash"),
        (F.col("chunk.original.place") - F.col("chunk.place")).alias("away")).withColumn("run", F.col("chunk.place") - rank)
    runs = ranked.groupBy(*passage, "run").agg(
        F.array_sort(F.collect_list("chunk")).alias("chunks"), F.sum("chunk.words").alias("words")).filter(F.col("words") >= seed_words)

    def edges(part: Column, side: int) -> Column:
        return F.transform(part, lambda c: F.struct(
            F.lit(side).alias("side"), c.place.alias("place"), c.original.id.alias("o_id"), c.original.text_hash.alias("o_hash"),
            c.original.place.alias("o_place")))

    some = F.least(F.lit(EDGES), F.size("chunks"))
    return runs.select(
        "id", "text_hash", F.get("chunks", F.lit(0)).place.alias("first_place"), F.element_at("chunks", -1).place.alias("last_place"),
        "words", F.array_sort(F.array_distinct("chunks.original.id")).alias("original_ids"),
        F.concat(edges(F.slice("chunks", F.lit(1), some), 0), edges(F.slice("chunks", -some, some), 1)).alias("edges"))


def _contexts(docs: DataFrame, doc_id: str, text: str, wanted: DataFrame, reach: int) -> DataFrame:
    """o_id, o_hash, o_place, before and after: the hashes of the ``CONTEXT`` words around each wanted (o_id, o_hash, o_place)."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = 0
            for part in slices(as_bytes(batch.text)):
                c = Chunks(part, reach)
                chunk_of = np.searchsorted(c.doc, np.arange(len(part) + 1))
                for k in range(len(part)):
                    row = batch.iloc[at + k]
                    low, high = c.text_words[k], c.text_words[k + 1]
                    places = np.asarray(row.places)
                    first, last = c.first[chunk_of[k] + places], c.last[chunk_of[k] + places]
                    yield pd.DataFrame({
                        "o_id": row.o_id, "o_hash": row.o_hash, "o_place": places,
                        "before": [c.hash[max(low, f - CONTEXT):f].tobytes() for f in first],
                        "after": [c.hash[e:min(high, e + CONTEXT)].tobytes() for e in last]})
                at += len(part)

    asked = wanted.groupBy("o_id", "o_hash").agg(F.collect_set("o_place").alias("places"))
    may, _ = prefilter.split(_keyed(docs, doc_id, text), F.xxhash64("id", "text_hash"), asked.select(F.xxhash64("o_id", "o_hash").alias("key")))
    own = may.hint("merge").join(asked, (F.col("id") == F.col("o_id")) & (F.col("text_hash") == F.col("o_hash")))
    found = own.select("o_id", "o_hash", "places", "text").mapInPandas(
        run, "o_id long, o_hash long, o_place int, before binary, after binary")
    return found.groupBy("o_id", "o_hash", "o_place").agg(F.first("before").alias("before"), F.first("after").alias("after"))


def _agreeing(own: np.ndarray, other: np.ndarray) -> int:
    """How many leading items of two rows are equal."""
    n = min(len(own), len(other))
    unequal = np.flatnonzero(own[:n] != other[:n])
    return int(unequal[0]) if len(unequal) else n


def _spans(c: Chunks, text: int, chunk: int, runs: list, edges: list, least_words: int) -> list[tuple[int, int]]:
    """Words (numbered within all texts) of a text's passages; ``chunk`` is its first chunk."""
    low, high = int(c.text_words[text]), int(c.text_words[text + 1])
    out: list[tuple[int, int]] = []
    for first, last in runs:
        a, b = int(c.first[chunk + first]), int(c.last[chunk + last])
        for side, place, context in edges:
            if first <= place <= last:
                near = np.frombuffer(context, dtype=np.uint64)
                if side == 0:
                    at = int(c.first[chunk + place])
                    a = min(a, at - _agreeing(c.hash[low:at][::-1], near[::-1]))
                else:
                    at = int(c.last[chunk + place])
                    b = max(b, at + _agreeing(c.hash[at:high], near))
        if b - a >= least_words:
            out.append((a, b))
    merged: list[tuple[int, int]] = []
    for a, b in sorted(out):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def _cut(texts: list[bytes], runs: list, edges: list, reach: int, least_words: int) -> Iterator[tuple[str, list[dict], int]]:
    """Of each text what is left, the byte spans that went, and how many words they held."""
    at = 0
    for part in slices(texts):
        c = Chunks(part, reach)
        chunk_of = np.searchsorted(c.doc, np.arange(len(part) + 1))
        for k, text in enumerate(part):
            kept, gone, since, words = [], [], 0, 0
            for a, b in _spans(c, k, int(chunk_of[k]), runs[at + k], edges[at + k], least_words):
                begin, end = int(c.start[a]), int(c.start[b]) if b < c.text_words[k + 1] else len(text)
                kept.append(text[since:begin])
                gone.append({"start": begin, "end": end})
                since, words = end, words + b - a
            kept.append(text[since:])
            yield b"".join(kept).decode("utf-8", "surrogatepass"), gone, words
        at += len(part)


def _with_cuts(docs: DataFrame, doc_id: str, text: str, reach: int, least_words: int) -> DataFrame:
    """row (all columns of ``docs``), text, id and, where a passage may go, ids and cut (text, spans, words)."""
    spark, folder = docs.sparkSession, work_folder(docs.sparkSession, "substring-dedup")

    def stored(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    runs = stored(passages(docs, doc_id, text, reach), "runs")
    edges = runs.select("id", "text_hash", F.explode("edges").alias("e")).select("id", "text_hash", "e.*")
    contexts = stored(_contexts(docs, doc_id, text, edges.select("o_id", "o_hash", "o_place").distinct(), reach), "contexts")
    context = F.when(F.col("side") == 0, F.col("before")).otherwise(F.col("after"))
    # Edges meet their contexts, then the runs of their text; an original that very many texts share is split by Spark.
    sides = edges.join(contexts, ["o_id", "o_hash", "o_place"]).select(
        "id", "text_hash", F.struct("side", "place", context.alias("context")).alias("edge"), F.lit(None).alias("run"), F.lit(None).alias("own_ids"))
    spans = runs.select("id", "text_hash", F.lit(None).alias("edge"), F.struct("first_place", "last_place").alias("run"),
                        F.col("original_ids").alias("own_ids"))
    found = stored(sides.unionByName(spans).groupBy("id", "text_hash").agg(
        F.collect_list("run").alias("runs"), F.collect_list("edge").alias("edges"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("own_ids")))).alias("ids")
    ).withColumnsRenamed({"id": "f_id", "text_hash": "f_hash"}), "found")
    # The whole row lies in one column, so no name of its own can clash with one of these.
    whole = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"), F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)).alias("id"),
                        F.xxhash64(text).alias("text_hash"))
    may, untouched = prefilter.split(whole, F.xxhash64("id", "text_hash"), found.select(F.xxhash64("f_id", "f_hash").alias("key")))
    same: Column = (F.col("id") == F.col("f_id")) & (F.col("text_hash") == F.col("f_hash"))

    @F.pandas_udf("text string, spans array<struct<start:long,end:long>>, words long")
    def cut(texts: pd.Series, runs: pd.Series, edges: pd.Series) -> pd.DataFrame:
        def rows(column: pd.Series) -> list:
            return [[tuple(r.values()) if isinstance(r, dict) else tuple(r) for r in own] if own is not None else [] for own in column]

        return pd.DataFrame(_cut(as_bytes(texts), rows(runs), rows(edges), reach, least_words), columns=["text", "spans", "words"])

    joined = may.hint("merge").join(found, same, "left").drop("f_id", "f_hash")
    some = F.col("runs").isNotNull()
    joined = joined.withColumn("cut", cut(F.when(some, F.col("text")), F.col("runs"), F.col("edges"))).drop("runs", "edges")
    # Where nothing went, the text stays as it was.
    joined = joined.withColumn("cut", F.when(F.coalesce(F.col("cut.words") > 0, F.lit(False)), F.col("cut")))
    return joined.unionByName(untouched, allowMissingColumns=True)


def cleaned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", reach: int = REACH,
            least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with its repeated passages removed from ``text``."""
    found = _with_cuts(docs, doc_id, text, reach, least_words)
    new = F.when(F.col("cut").isNotNull(), F.col("cut.text")).otherwise(F.col("text"))
    return found.select(*[new.alias(name) if name == text else F.col("row").getField(name).alias(name) for name in docs.columns])


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", reach: int = REACH,
          least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id and text without its repeated passages, with what went and whence.

    removed_words counts, removed_spans are bytes of the UTF-8 text as it was, original_ids the documents that
    hold the originals (``LAST_ID`` for one without an id).
    """
    found = _with_cuts(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "doc_id", "text", reach, least_words)
    spans, some = "array<struct<start:long,end:long>>", F.col("cut").isNotNull()
    return found.select(
        "row.doc_id", F.when(some, F.col("cut.text")).otherwise(F.col("text")).alias("text"),
        F.coalesce("cut.words", F.lit(0).cast("long")).alias("removed_words"),
        F.when(some, F.col("cut.spans")).otherwise(F.array().cast(spans)).alias("removed_spans"),
        F.when(some, F.col("ids")).otherwise(F.array().cast("array<long>")).alias("original_ids"))
