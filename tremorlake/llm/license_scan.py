"""License notices found by phrases and by an exact set-similarity join, in DataFrame operations only.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z became a-z. Two ways to find a license:

* *Phrases.* Every place where the words of a phrase stand consecutively.
* *Set-similarity join.* A text matches a template when any ``BLOCK_WORDS`` consecutive words, whatever their lines, hold at least
  ``threshold`` of the template's distinct words. Windows that start within the same ``BLOCK_WORDS`` words are first taken together as
  one block. Words are ordered by their frequency in the whole
  corpus, rarest first. A block that reaches the threshold must share one of the first ``n - need + 1`` words of the template's
  order (prefix filter), hold at least ``need`` distinct words (length filter), and at the first shared word enough words
  must be left on both sides (positional filter). Of the pairs that pass every window is counted exactly, and every match stands: a
  notice that holds a shorter one's words as well gets both labels.

Templates are a short list of fixed values, so their prefixes are a literal in the scan and their table is
broadcast by its size. Blocks without any prefix word never leave the task that reads them; the join
back to documents moves hashes only.

Defined results: a null text is empty and has no words, no places and score 0; rows that repeat ``doc_id`` and
text get the same answer; null ids are kept; other columns are not read.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases and their labels, and short notices as license texts and their authors print them.
PHRASES = {
    "mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-2", "this work is licensed under the gnu general public license version 2"),
    ("lgpl-3", "this work is licensed under the gnu lesser general public license version 3"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("proprietary", "copyright all rights reserved unauthorized copying of this file is strictly prohibited"),
]

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.8
BLOCK_WORDS = 64


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(low: Column) -> Column:
    return F.array_remove(F.split(low, SEPARATORS), "")


def _need(n_words: int, threshold: float) -> int:
    """How many of a template's distinct words a block must hold."""
    return next(k for k in range(n_words + 1) if k / n_words >= threshold)


def _template_rows(templates, threshold: float) -> list[tuple[int, str, list[str], int]]:
    sets = [sorted(set(text.split())) for _, text in templates]
    return [(i, label, tokens, _need(len(tokens), threshold)) for i, ((label, _), tokens) in enumerate(zip(templates, sets))]


def word_counts(docs: DataFrame, text: str, vocabulary: list[str]) -> dict[str, int]:
    """In how many texts of the corpus each word of a fixed vocabulary occurs; the answer is as long as that list."""
    own = F.array(*map(F.lit, vocabulary))
    found = docs.select(F.explode(F.array_intersect(words(lowered(F.col(text))), own)).alias("word"))
    return {r.word: r["count"] for r in found.groupBy("word").count().collect()}


def _last_window(words: Column, step: int) -> Column:
    """Where the last window starts: the first that reaches the end."""
    return F.greatest(F.size(words) - BLOCK_WORDS + step - 1, F.lit(0))


def _blocks(low: Column, step: int) -> Column:
    """Word arrays of a text's blocks: all words of the windows that start in the same ``BLOCK_WORDS`` words."""
    starts = lambda w: F.sequence(F.lit(0), _last_window(w, step), F.lit(BLOCK_WORDS))
    return F.flatten(F.transform(F.array(words(low)), lambda w: F.transform(
        starts(w), lambda at: F.slice(w, at + 1, 2 * BLOCK_WORDS - step))))


def _most_shared(block: str, tokens: str, step: int) -> Column:
    """The most words of a template that one window of a block holds."""
    starts = F.sequence(F.lit(0), _last_window(F.col(block), step), F.lit(step))
    return F.array_max(F.transform(starts, lambda at: F.size(F.array_intersect(tokens, F.slice(block, at + 1, BLOCK_WORDS)))))


def matches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates=None,
            threshold: float = THRESHOLD, step: int = BLOCK_WORDS // 2) -> DataFrame:
    """doc_id, text_hash, block, label and containment for each block and each template one of its windows holds.

    Windows start at every ``step`` words, a divisor of ``BLOCK_WORDS``.
    """
    if BLOCK_WORDS % step:
        raise ValueError(f"step must divide {BLOCK_WORDS}")
    spark = docs.sparkSession
    rows = _template_rows(TEMPLATES if templates is None else templates, threshold)
    vocabulary = sorted({t for _, _, tokens, _ in rows for t in tokens})
    seen = word_counts(docs, text, vocabulary)
    ranked = sorted(vocabulary, key=lambda t: (seen.get(t, 0), t))
    rank = {t: i for i, t in enumerate(ranked)}
    ordered = [(i, label, sorted(tokens, key=rank.get), need) for i, label, tokens, need in rows]
    prefixes = sorted({t for _, _, tokens, need in ordered for t in tokens[:len(tokens) - need + 1]}, key=rank.get)

    table = spark.createDataFrame(
        [(t, i, label, tokens, need, place) for i, label, tokens, need in ordered
         for place, t in enumerate(tokens[:len(tokens) - need + 1])],
        "word string, template int, label string, tokens array<string>, need int, place int")
    low = lowered(F.col(text))
    some = rf"(?:^|{SEPARATORS[:-1]})(?:{'|'.join(prefixes)})(?:{SEPARATORS[:-1]}|$)"
    order, front = F.array(*map(F.lit, ranked)), F.array(*map(F.lit, prefixes))
    blocks = (docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), low.alias("low"))
              .filter(F.col("low").rlike(some))
              .select("doc_id", "text_hash", F.posexplode(_blocks(F.col("low"), step)).alias("block", "words"))
              .filter(F.arrays_overlap("words", front))
              # Only words of templates can be shared; the others count as rarer or later words of the block.
              .select("doc_id", "text_hash", "block", "words", F.size(F.array_distinct("words")).alias("distinct_words"),
                      F.array_intersect(order, F.col("words")).alias("shared")))
    probes = blocks.select("*", F.posexplode("shared").alias("position", "word")).filter(F.col("word").isin(prefixes))
    joined = probes.join(table, "word")
    left_in_both = F.least(F.size("tokens") - F.col("place"), F.size("shared") - F.col("position"))
    overlap = F.size(F.array_intersect("shared", "tokens"))
    hits = (joined
            .filter(F.col("distinct_words") >= F.col("need"))
            # The first shared word of a pair decides, so a pair is counted once.
            .filter(F.array_position("shared", F.array_intersect("tokens", "shared")[0]) == F.col("position") + 1)
            .filter(left_in_both >= F.col("need"))
            .filter(overlap >= F.col("need"))
            .withColumn("overlap", _most_shared("words", "tokens", step)).filter(F.col("overlap") >= F.col("need"))
            .select("doc_id", "text_hash", "block", "label", (F.col("overlap") / F.size("tokens")).alias("containment")))
    # Rows that repeat a document repeat its hits.
    return hits.distinct()


def _places(phrase: str) -> Column:
    """Word numbers at which a phrase starts; only texts that spell it are looked through."""
    first, *rest = phrase.split()
    same = lambda i: [F.get("words", i + k + 1) == word for k, word in enumerate(rest)]
    at = F.sequence(F.lit(0), F.size("words") - 1)

    def starts(i: Column) -> Column:
        test = F.get("words", i) == first
        for one in same(i):
            test = test & F.coalesce(one, F.lit(False))
        return test

    spelled = F.col("low").rlike(SEPARATORS.join(phrase.split()))
    return F.when(spelled, F.filter(at, starts)).otherwise(F.array().cast("array<int>"))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates=None,
         threshold: float = THRESHOLD, phrases: dict[str, str] | None = None) -> DataFrame:
    """One row per document: its words, the places of the phrases, the labels of both ways and a score.

    ``phrases`` maps the words of each phrase to its label (``PHRASES`` where none are given). No window of a text is left out. The score is 1 with a phrase, else the largest containment of a matching template, else 0.
    """
    phrases = PHRASES if phrases is None else phrases
    found = matches(docs, doc_id, text, templates, threshold, step=1).groupBy("doc_id", "text_hash").agg(
        F.collect_set("label").alias("more"), F.max("containment").alias("containment"))
    rows = (docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), lowered(F.col(text)).alias("low"))
            .withColumn("words", words(F.col("low")))
            .select("doc_id", "text_hash", F.size("words").cast("long").alias("n_words"),
                    *[_places(p).alias(f"at_{k}") for k, p in enumerate(phrases)]))
    places = F.concat(*[F.col(f"at_{k}") for k in range(len(phrases))])
    base = F.array_compact(F.array(*[F.when(F.size(f"at_{k}") > 0, label) for k, label in enumerate(phrases.values())]))
    rows = rows.select("doc_id", "text_hash", "n_words", F.size(places).cast("long").alias("n_base"),
                       F.array_min(places).cast("long").alias("first_word"),
                       F.array_max(places).cast("long").alias("last_word"), F.array_distinct(base).alias("base"))
    other = found.withColumnsRenamed({"doc_id": "o_id", "text_hash": "o_hash"})
    joined = rows.join(other, rows.doc_id.eqNullSafe(other.o_id) & rows.text_hash.eqNullSafe(other.o_hash), "left")
    labels = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    return joined.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                         F.array_join(F.array_sort("base"), ",").alias("base_labels"),
                         F.array_join(labels, ",").alias("labels"),
                         F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"))
