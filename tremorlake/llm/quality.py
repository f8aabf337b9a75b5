"""Quality selection by importance resampling.

Two bags of hashed n-grams (words and runs of signs, one and two of them, case kept) are counted: one of the
target, texts labelled as good, and one of the raw corpus, every text. The log weight of a text is the sum over its n-grams
of ``log(target share / raw share)`` of their buckets. Gumbel noise, fixed by the text's id and content, is added, and
the rows with the largest sums are the sample without replacement that importance weights ask for.

* Raw counts cover every row. The target model is fitted on at most ``SAMPLE`` labelled rows, those with the
  smallest hash of their id, so the list of their ids has a fixed bound and is broadcast.
* A task emits at most one row per bucket, and the model is two numbers per bucket whatever the corpus.
* The cut of the top k is found by rounds of counting in ``BINS`` bins over stored scores; the driver sees the counts of
  one round, and no task sorts the corpus.

Defined results: null and empty texts have no n-grams and weight 0; without labelled good rows every weight
is 0; rows equal in id and text have one sum and are taken or left together, as are all rows that tie at the
cut; an empty table gives an empty result.
"""

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorlake.llm.shipping import ship
from tremorlake.llm.textkit import Words, as_bytes, mix, slices
from tremorlake.session import work_folder

BUCKETS = 10_000
#: Labelled good rows the target model is fitted on, at most.
SAMPLE = 20_000
#: Counts added to every bucket.
SMOOTHING = 1.0
BINS = 2048
#: Rows of a bin among which the cut is taken directly.
FEW = 5000


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of every n-gram."""
    words = Words(texts, signs=True)
    if not len(words.hash):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    pair = mix(words.hash[:-1] * np.uint64(3) + words.hash[1:])[words.doc[:-1] == words.doc[1:]]
    of_pair = words.doc[:-1][words.doc[:-1] == words.doc[1:]]
    hashes, docs = np.concatenate([words.hash, pair]), np.concatenate([words.doc, of_pair])
    return (hashes % np.uint64(BUCKETS)).astype(np.int64), docs


def _good(labels: DataFrame, sample: int) -> DataFrame:
    good = labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """The log ratio of target and raw share for each bucket."""
    good = F.broadcast(_good(labels, sample).withColumn("good", F.lit(True)))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(good, "doc_id", "left").select(
        "text", F.coalesce("good", F.lit(False)).alias("good"))

    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        raw, target = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            good_rows, at = batch.good.to_numpy(), 0
            for part in slices(as_bytes(batch.text)):
                bucket, doc = features(part)
                raw += np.bincount(bucket, minlength=BUCKETS)
                target += np.bincount(bucket[good_rows[at:at + len(part)][doc]], minlength=BUCKETS)
                at += len(part)
        found = np.flatnonzero(raw)
        yield pd.DataFrame({"bucket": found, "raw": raw[found], "target": target[found]})

    counts = rows.mapInPandas(count, "bucket int, raw long, target long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()  # a row per bucket
    raw, target = np.full(BUCKETS, SMOOTHING), np.full(BUCKETS, SMOOTHING)
    raw[counts.bucket] += counts.raw
    target[counts.bucket] += counts.target
    if not counts.target.sum():
        return np.zeros(BUCKETS)
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def weighted(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """``docs`` with log_weight, n_grams and selection_key, the log weight with its noise."""

    @F.pandas_udf("n_grams long, log_weight double")
    def weigh(batch: pd.Series) -> pd.DataFrame:
        sizes, sums = [], []
        for part in slices(as_bytes(batch)):
            bucket, doc = features(part)
            sizes.append(np.bincount(doc, minlength=len(part)))
            sums.append(np.bincount(doc, weights=ratio[bucket], minlength=len(part)))
        return pd.DataFrame({"n_grams": np.concatenate(sizes or [np.zeros(0, dtype=np.int64)]),
                             "log_weight": np.concatenate(sums or [np.zeros(0)])})

    found = docs.withColumn("__w", weigh(F.col("text").cast("string")))
    return found.withColumns({"n_grams": F.col("__w.n_grams"), "log_weight": F.col("__w.log_weight"),
                              "selection_key": F.col("__w.log_weight") + gumbel("doc_id", "text")}).drop("__w")


def gumbel(*columns: str) -> Column:
    """Standard Gumbel noise fixed by columns."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit("gumbel"), *columns), 12) + 0.5) / float(1 << 52)
    return -F.log(-F.log(uniform))


def cut(rows: DataFrame, key: str, k: int) -> float:
    """The k-th largest value of a column; the rows must be cheap to read more than once."""
    if k <= 0:
        return math.inf
    low, high, total = rows.agg(F.min(key), F.max(key), F.count(key)).first()
    if k >= total:
        return -math.inf
    while True:
        inside = rows.filter((F.col(key) >= low) & (F.col(key) <= high))
        width = (high - low) / BINS
        if width <= 0 or not low + width > low:
            return low if width <= 0 else inside.agg(F.min(key)).first()[0]
        place = F.least(F.floor((F.col(key) - low) / width), F.lit(BINS - 1))
        bins = {r.bin: r for r in inside.groupBy(place.alias("bin")).agg(
            F.count(F.lit(1)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high")).collect()}
        for number in sorted(bins, reverse=True):
            if k <= bins[number].n:
                break
            k -= bins[number].n
        low, high, n = bins[number].low, bins[number].high, bins[number].n
        if n <= FEW:
            top = rows.filter((F.col(key) >= low) & (F.col(key) <= high)).select(key).orderBy(F.desc(key)).limit(k)
            return top.agg(F.min(key)).first()[0]


def select(docs: DataFrame, labels: DataFrame, share: float | None = None, sample: int = SAMPLE) -> DataFrame:
    """doc_id, n_grams, log_weight, selection_key and kept for every row.

    ``share`` is the part of the rows to take; by default the part of the labelled rows that is good.
    """
    spark = ship(docs.sparkSession)
    ratio = fit(docs, labels, sample)
    if share is None:
        share = labels.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
        share = 1.0 if share is None else share
    path = f"{work_folder(spark, 'quality')}/scored"
    (weighted(docs.select("doc_id", "text"), ratio).select("doc_id", "n_grams", "log_weight", "selection_key")
     .write.parquet(path))
    rows = spark.read.parquet(path)
    least = cut(rows, "selection_key", round(share * rows.count()))
    return rows.withColumn("kept", F.col("selection_key") >= F.lit(least))
