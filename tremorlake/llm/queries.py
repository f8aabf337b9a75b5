"""The queries of this subpackage and their DuckDB SQL, each over the whole of its tables."""

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorlake.llm import (
    bpe_reuse,
    byte_bpe,
    exact_dedup,
    fingerprints,
    html_render,
    license_scan,
    merkle_manifest,
    near_join,
    packing,
    quality,
    ranked_search,
    substring_dedup,
    toxicity,
    vector_dedup,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_render.extract(_table(spark, sf_dir, "pages").select("page_id", "html")).select(
        "page_id", "text", F.length("text").cast("long").alias("n_chars"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(_table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.dedup(docs)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoder = byte_bpe.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(_table(spark, sf_dir, "documents"), encoder).drop("ids")


def op5_bpe_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_reuse.encode_decode(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), digests=True)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    scores = toxicity.scored(docs.select("doc_id", "text"), model)
    return scores.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_join.join(_table(spark, sf_dir, "documents"))


def op9_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.dedup(_table(spark, sf_dir, "embeddings"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.select(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.neighbours(_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    intact = [F.col(f) for f in merkle_manifest.FIELDS]
    forged = [F.col(f) + 1 if f == "n_chars" else F.col(f) for f in merkle_manifest.FIELDS]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    claimed = F.when(tampered, merkle_manifest.leaf(forged)).otherwise(merkle_manifest.leaf(intact))
    proofs = merkle_manifest.manifest(docs, claimed=claimed)
    found = proofs.select("doc_id", "leaf", "subroot", "root", merkle_manifest.proof_digest(F.col("path")).alias("proof_sha256"),
                          merkle_manifest.folded(F.col("claimed"), F.col("path")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


# The phrases that the query's contract names.
LICENSE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"), phrases=LICENSE_PHRASES)


def _license_sql() -> str:
    """Every 64 consecutive words of a text against every template whose words the text holds."""
    templates = ", ".join(
        f"({i}, '{label}', {tokens}, {need})" for i, label, tokens, need in
        license_scan._template_rows(license_scan.TEMPLATES, license_scan.THRESHOLD))
    word = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
    places = "list_concat(" + ", ".join(
        "list_filter(range(len(words)), lambda i: list_slice(words, i + 1, i + {n}) = {p})".format(
            n=len(phrase.split()), p=phrase.split()) for phrase in LICENSE_PHRASES) + ")"
    base = ", ".join(
        "CASE WHEN contains(' ' || array_to_string(words, ' ') || ' ', ' {p} ') THEN '{label}' END".format(
            p=phrase, label=label) for phrase, label in LICENSE_PHRASES.items())
    size = license_scan.BLOCK_WORDS
    return f"""
WITH templates(template, label, tokens, need) AS (VALUES {templates}),
low AS (SELECT row_number() OVER () AS r, doc_id,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
w AS (SELECT r, doc_id, regexp_extract_all(low, '{word}') AS words FROM low),
whole AS (SELECT r, label, tokens, need, words FROM w JOIN templates ON len(list_intersect(tokens, words)) >= need),
block AS (SELECT r, label, tokens, need, list_slice(words, pos + 1, pos + {size}) AS words FROM (
    SELECT *, unnest(range(0, greatest(len(words) - {size} + 1, 1))) AS pos FROM whole)),
hit AS (SELECT r, label, len(list_intersect(tokens, words)) / len(tokens) AS containment
    FROM block WHERE len(list_intersect(tokens, words)) >= need),
more AS (SELECT r, list(DISTINCT label) AS more, max(containment) AS containment FROM hit GROUP BY r),
p AS (SELECT r, doc_id, words, {places} AS places, list_filter([{base}], lambda x: x IS NOT NULL) AS base FROM w)
SELECT doc_id, len(words) AS n_words, len(places) AS n_base, list_min(places) AS first_word, list_max(places) AS last_word,
    array_to_string(list_sort(list_distinct(base)), ',') AS base_labels,
    array_to_string(list_sort(list_distinct(list_concat(base, coalesce(more, [])))), ',') AS labels,
    CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(containment, 0.0)::DOUBLE END AS score
FROM p LEFT JOIN more USING (r)"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_render": op1_html_render,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_packing": op4_packing,
    "op5_bpe_reuse": op5_bpe_reuse,
    "op6_toxicity": op6_toxicity,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_license_scan": op8_license_scan,
    "op9_vector_dedup": op9_vector_dedup,
    "op10_quality": op10_quality,
    "op11_fingerprints": op11_fingerprints,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_ranked_search": op13_ranked_search,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op2_exact_dedup": r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(n.norm) AS text_sha256
FROM n JOIN g USING (norm)""",
    "op7_ngram_jaccard": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
s AS (SELECT doc_id, list_sort(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END) AS grams
    FROM w),
c AS (SELECT grams, min(doc_id) AS node, count(*) AS copies FROM s WHERE len(grams) > 0 GROUP BY grams),
g AS (SELECT node, copies, len(grams) AS n, unnest(grams) AS gram FROM c),
p AS (SELECT a.node AS a, b.node AS b, any_value(b.copies) AS copies, count(*) AS shared, any_value(a.n + b.n) AS n
    FROM g a JOIN g b ON a.gram = b.gram AND a.node != b.node GROUP BY ALL),
l AS (SELECT a, b, copies FROM p WHERE 5 * shared >= 4 * (n - shared)),
r(node, root) AS (SELECT a, a FROM l UNION SELECT l.b, r.root FROM r JOIN l ON r.node = l.a),
k AS (SELECT node, min(root) AS class_id FROM r GROUP BY node),
d AS (SELECT a, sum(copies) AS links FROM l GROUP BY a),
o AS (SELECT s.doc_id, coalesce(k.class_id, c.node, s.doc_id) AS class_id,
    CAST(coalesce(c.copies - 1, 0) + coalesce(d.links, 0) AS BIGINT) AS n_links
    FROM s LEFT JOIN c ON s.grams = c.grams LEFT JOIN k ON k.node = c.node LEFT JOIN d ON d.a = c.node)
SELECT doc_id, class_id, n_links, doc_id = class_id AS kept FROM o""",
    "op8_license_scan": _license_sql(),
    "op13_ranked_search": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
k AS (SELECT count(*) AS n_docs, sum(len(words))::BIGINT AS n_terms FROM d WHERE len(words) > 0),
q AS (SELECT i, item_id, unnest(list_distinct(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term FROM (SELECT row_number() OVER () AS i, * FROM benchmark)),
f AS (SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf FROM (
    SELECT r, doc_id, len(words) AS n, unnest(words) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY r, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM f GROUP BY term), k),
s AS (SELECT i, item_id, r, any_value(doc_id) AS doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM q JOIN f USING (term) JOIN w USING (term), k GROUP BY i, item_id, r),
o AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
    FROM s WHERE score > 0)
SELECT * FROM o WHERE rank <= 50""",
    "op12_merkle_manifest": """
WITH RECURSIVE bytes AS (SELECT *, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)) AS b FROM documents),
crc AS (SELECT *, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: list_reduce(list_prepend(xor(c, x), [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295) AS crc FROM bytes),
fields AS (SELECT doc_id, lang, crc % 7 = 0 AS tampered, n_chars,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') AS head, coalesce(strlen(text) || ':' || text, '-') AS tail FROM crc),
hashed AS (SELECT doc_id, lang, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
    CASE WHEN tampered THEN sha256(head || coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || tail) END AS forged
    FROM fields),
leaves AS (SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '') AS g, leaf, coalesce(forged, leaf) AS claimed,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM hashed),
nodes(g, level, i, h, n) AS (SELECT g, 0, i, leaf, count(*) OVER (PARTITION BY g) FROM leaves
    UNION ALL SELECT g, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 1) // 2 FROM nodes WHERE n > 1 GROUP BY g, level, i // 2),
subroots AS (SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(level, i, h, n) AS (SELECT 0, i, h, n FROM subroots
    UNION ALL SELECT level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 1) // 2 FROM tops WHERE n > 1 GROUP BY level, i // 2),
fold(r, g, level, i, h, proof, n) AS (SELECT r, l.g, 0, l.i, claimed, '', n FROM leaves l JOIN nodes o ON o.g = l.g AND o.level = 0 AND o.i = l.i
    UNION ALL SELECT r, f.g, f.level + 1, f.i // 2,
        sha256(CASE WHEN s.h IS NULL THEN f.h WHEN s.i < f.i THEN s.h || f.h ELSE f.h || s.h END), proof || coalesce(s.h, ''), (f.n + 1) // 2
    FROM fold f LEFT JOIN nodes s ON s.g = f.g AND s.level = f.level AND s.i = xor(f.i, 1) WHERE f.n > 1),
rise(r, level, i, h, proof, n) AS (SELECT r, 0, s.i, f.h, proof, s.n FROM fold f JOIN subroots s USING (g) WHERE f.n = 1
    UNION ALL SELECT r, f.level + 1, f.i // 2,
        sha256(CASE WHEN s.h IS NULL THEN f.h WHEN s.i < f.i THEN s.h || f.h ELSE f.h || s.h END), proof || coalesce(s.h, ''), (f.n + 1) // 2
    FROM rise f LEFT JOIN tops s ON s.level = f.level AND s.i = xor(f.i, 1) WHERE f.n > 1),
root AS (SELECT h FROM tops WHERE n = 1)
SELECT doc_id, leaf, s.h AS subroot, root.h AS root, sha256(rise.proof) AS proof_sha256, rise.h AS folded_root, rise.h = root.h AS verified
FROM leaves JOIN rise USING (r) JOIN subroots s ON s.g = leaves.g CROSS JOIN root WHERE rise.n = 1""",
    "op9_vector_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND v IS NOT NULL AND len(v) > 0
    AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x != 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
    ON a.label = b.label AND a.vec_id != b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
r(node, root) AS (SELECT a, a FROM l UNION SELECT l.b, r.root FROM r JOIN l ON r.node = l.a),
k AS (SELECT node, min(root) AS component_id FROM r GROUP BY node),
d AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
    vec_id = coalesce(component_id, vec_id) AS kept
FROM v LEFT JOIN k ON k.node = vec_id LEFT JOIN d ON d.a = vec_id""",
}
