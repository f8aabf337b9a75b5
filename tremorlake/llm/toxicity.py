"""Toxicity by a factorization machine over hashed words.

A text is the set of its distinct words (:mod:`textkit`), hashed to ``BUCKETS`` terms. Its score is the logistic
function of ``b + sum w_i + sum_(i<j) <v_i, v_j>`` over its terms: besides a weight of its own, each term has
``FACTORS`` factors, so a pair of words can say more than its parts, as an insult beside the mention of a group.

The machine learns by mini-batches with adaptive steps (AdaGrad) from a bounded sample of labelled rows:
the ``SAMPLE`` ids with the smallest hash, and of their rows with different terms again the ``SAMPLE`` with the smallest
hash, in one task that its input and seed determine. Near copies in the sample count once, so a copied text doesn't vote many times. Terms in fewer than ``LEAST_TEXTS`` texts, or
whose share of toxic texts is within ``SIGMAS`` standard deviations of the sample's, get no weight and no
factors: a long text has thousands of terms that mean nothing. The model, ``BUCKETS x (FACTORS + 1)`` numbers
whatever the corpus, goes to the tasks that score; scoring has no shuffle.

Defined results: null and empty texts have no terms and get the score of the bias, which is held below 0.5; a
sample without both labels gives the share of toxic rows in it (0 without rows) as every score; labels that are null are not
learned from; rows that repeat an id are scored each; columns of all other names pass through ``filtered``.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorlake.llm.shipping import ship
from tremorlake.llm.textkit import Words, as_bytes, mix, seeds, slices

BUCKETS = 1 << 17
FACTORS = 4
#: Labelled rows learned from, at most.
SAMPLE = 20_000
LEAST_TEXTS, SIGMAS = 8, 4.0
EPOCHS = 40
#: Texts of a step; size of a step; pull of weights and factors towards 0.
BATCH, STEP, PULL, FACTOR_PULL = 256, 0.3, 1e-5, 1e-4
#: Part of a text's terms a step sees, picked at random, so that each telling term learns to do without the others.
KEPT_TERMS = 0.75
THRESHOLD = 0.7


def held_out(doc_id: Column) -> Column:
    """True for rows that are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def terms(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct terms of each text."""
    out = []
    for part in slices(texts):
        words = Words(part)
        pairs = np.unique(words.doc.astype(np.int64) * BUCKETS + (words.hash % np.uint64(BUCKETS)).astype(np.int64))
        cut = np.searchsorted(pairs, np.arange(len(part) + 1) * BUCKETS)
        pairs = (pairs % BUCKETS).astype(np.int32)
        out += [pairs[a:b] for a, b in zip(cut[:-1], cut[1:])]
    return out


class Machine:
    """Bias, weights and factors."""

    def __init__(self, bias: float, weights: np.ndarray, factors: np.ndarray):
        self.bias, self.weights, self.factors = bias, weights, factors

    def margin(self, flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score before the logistic function, and the sums of factors, of texts whose terms lie end to end."""
        ends = np.concatenate([[0], np.cumsum(sizes)])

        def sums(x):
            total = np.concatenate([np.zeros((1, *x.shape[1:])), np.cumsum(x, axis=0, dtype=np.float64)])
            return total[ends[1:]] - total[ends[:-1]]

        v = self.factors[flat]
        s = sums(v)
        pairs = 0.5 * ((s * s).sum(axis=1) - sums((v * v).sum(axis=1)))
        return self.bias + sums(self.weights[flat]) + pairs, s

    def score(self, sets: list[np.ndarray]) -> np.ndarray:
        if not sets:
            return np.zeros(0)
        margin, _ = self.margin(np.concatenate(sets), np.fromiter(map(len, sets), dtype=np.int64, count=len(sets)))
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))

    def to_bytes(self) -> bytes:
        return np.concatenate([[self.bias], self.weights, self.factors.ravel()]).astype("<f4").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> "Machine":
        x = np.frombuffer(data, dtype="<f4").astype(np.float64)
        return cls(float(x[0]), x[1:BUCKETS + 1], x[BUCKETS + 1:].reshape(BUCKETS, FACTORS))


def _unlike(sets: list[np.ndarray], bands: int = 12, rows: int = 4) -> np.ndarray:
    """Numbers of the sets that share no band of MinHash values with an earlier one; empty sets are left out."""
    full = np.array([i for i, s in enumerate(sets) if len(s)], dtype=np.int64)
    if not len(full):
        return full
    flat = mix(np.concatenate([sets[i] for i in full]).astype(np.uint64))
    starts = np.concatenate([[0], np.cumsum([len(sets[i]) for i in full])[:-1]])
    early = np.zeros(len(full), dtype=bool)
    factors = seeds("unlike", bands * rows).reshape(bands, rows)
    for band in factors:
        key = np.zeros(len(full), dtype=np.uint64)
        for factor in band:
            key = mix(key + np.minimum.reduceat(flat * factor, starts))
        _, first = np.unique(key, return_index=True)
        repeat = np.ones(len(full), dtype=bool)
        repeat[first] = False
        early |= repeat
    return full[~early]


def learn(sets: list[np.ndarray], labels: np.ndarray, seed: int = 1) -> Machine:
    """A machine from term sets and 0/1 labels."""
    rows = _unlike(sets)
    sets, labels = [sets[i] for i in rows], labels[rows].astype(np.float64)
    share = labels.mean() if len(labels) else 0.0
    prior = float(np.clip(share, 1e-9, 1 - 1e-9))
    prior = float(np.log(prior / (1 - prior)))
    if not 0 < share < 1:
        return Machine(prior, np.zeros(BUCKETS), np.zeros((BUCKETS, FACTORS)))
    flat, sizes = np.concatenate(sets), np.array([len(s) for s in sets])
    texts_of = np.bincount(flat, minlength=BUCKETS)
    toxic_of = np.bincount(flat, weights=np.repeat(labels, sizes), minlength=BUCKETS)
    telling = (texts_of >= LEAST_TEXTS) & (
        np.abs(toxic_of - share * texts_of) > SIGMAS * np.sqrt(share * (1 - share) * np.maximum(texts_of, 1)))
    sets = [s[telling[s]] for s in sets]
    rng = np.random.default_rng(seed)
    machine = Machine(min(prior, -0.1), np.zeros(BUCKETS), rng.normal(0, 0.05, (BUCKETS, FACTORS)))
    machine.factors[~telling] = 0
    past_bias, past_w, past_v = 1e-3, np.full(BUCKETS, 1e-3), np.full((BUCKETS, FACTORS), 1e-3)
    for _ in range(EPOCHS):
        order = rng.permutation(len(sets))
        for at in range(0, len(order), BATCH):
            batch = order[at:at + BATCH]
            seen = [sets[i][rng.random(len(sets[i])) < KEPT_TERMS] for i in batch]
            sizes, flat = np.array([len(s) for s in seen]), np.concatenate(seen)
            if not len(flat):
                continue
            margin, sums = machine.margin(flat, sizes)
            error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[batch]
            used, place = np.unique(flat, return_inverse=True)
            each = np.repeat(error, sizes)
            g = np.bincount(place, weights=each, minlength=len(used)) + PULL * BATCH * machine.weights[used]
            v = machine.factors[used]
            spread = np.repeat(error[:, None] * sums, sizes, axis=0)
            own = np.bincount(place, weights=each, minlength=len(used))
            gv = np.stack([np.bincount(place, weights=spread[:, f], minlength=len(used)) for f in range(FACTORS)], axis=1)
            gv += -own[:, None] * v + FACTOR_PULL * BATCH * v
            past_w[used] += g * g
            past_v[used] += gv * gv
            past_bias += error.sum() ** 2
            machine.weights[used] -= STEP * g / np.sqrt(past_w[used])
            machine.factors[used] -= STEP * gv / np.sqrt(past_v[used])
            machine.bias -= STEP * error.sum() / np.sqrt(past_bias)
    machine.bias = min(machine.bias, -0.1)
    return machine


def sampled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, toxic and terms of at most ``sample`` labelled rows that are not held out, in one partition."""
    ship(docs.sparkSession)
    rows = (labels.select(F.col("doc_id"), F.col("toxic").cast("double").alias("toxic"))
            .filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(rows), "doc_id")

    def term_sets(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = terms(as_bytes(batch.text))
            yield pd.DataFrame({"doc_id": batch.doc_id.to_numpy(), "toxic": batch.toxic.to_numpy(),
                                "terms": [t.tobytes() for t in found]})

    sets = texts.mapInPandas(term_sets, "doc_id long, toxic double, terms binary")
    # An id may have any number of rows.
    return (sets.groupBy("doc_id", "terms").agg(F.max("toxic").alias("toxic"))
            .orderBy(F.xxhash64("doc_id", "terms"), "doc_id", "terms").limit(sample).coalesce(1))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> bytes:
    """The machine learned from labelled rows that are not held out, as bytes of a fixed length."""

    def machine(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.concat([pd.DataFrame({"doc_id": [], "toxic": [], "terms": []}), *batches])
        held = held.sort_values(["doc_id", "terms"], kind="stable")
        learned = learn([np.frombuffer(t, dtype=np.int32) for t in held.terms], held.toxic.to_numpy() > 0)
        yield pd.DataFrame({"machine": [learned.to_bytes()]})

    got = sampled(docs, labels, sample).mapInPandas(machine, "machine binary").collect()  # one row of a fixed length
    return bytes(got[0].machine) if got else Machine(-30.0, np.zeros(BUCKETS), np.zeros((BUCKETS, FACTORS))).to_bytes()


def scores(spark: SparkSession, model: bytes, text: Column) -> Column:
    """The score of a text column."""
    shared = ship(spark).sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = Machine.from_bytes(shared.value)
        for batch in batches:
            out = [machine.score(terms(part)) for part in slices(as_bytes(batch), 8 << 20)]
            yield pd.Series(np.concatenate(out) if out else np.zeros(0))

    return of(text.cast("string"))


def scored(docs: DataFrame, model: bytes, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with a score column more."""
    return docs.withColumn(score, scores(docs.sparkSession, model, F.col(text)))


def filtered(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with their columns."""
    return docs.filter(scores(docs.sparkSession, fit(docs, labels), F.col("text")) < threshold)
