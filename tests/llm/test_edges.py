"""Every operator on odd rows, on an empty table and beside columns of clashing names."""

import public_tokenizers
import pytest

import corpus_pipeline
from tremorlake.llm import (
    bpe_reuse,
    byte_bpe,
    exact_dedup,
    html_render,
    license_scan,
    near_join,
    packing,
    quality,
    substring_dedup,
    textkit,
    toxicity,
    vector_dedup,
)

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (5, 1, 0), (6, 0, 1), (8, None, None), (None, 1, 1)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def per_row(labels):
    """Operators that answer with one row per row."""
    return {
        "exact": exact_dedup.decide,
        "substring": substring_dedup.dedup,
        "cleaned": substring_dedup.cleaned,
        "bpe": lambda d: bpe_reuse.encode_decode(d, WORDS),
        "digests": lambda d: bpe_reuse.encode_decode(d, WORDS, digests=True),
        "toxicity": lambda d: toxicity.scored(d.select("doc_id", "text"), toxicity.fit(d, labels)),
        "near": near_join.join,
        "license": license_scan.scan,
        "quality": lambda d: quality.select(d, labels),
    }


NAMES = ("exact", "substring", "cleaned", "bpe", "digests", "toxicity", "near", "license", "quality")


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(documents, odd_rows, per_row, name):
    out = per_row[name](documents(odd_rows))
    ids = sorted(r.doc_id is not None and r.doc_id or 0 for r in out.collect())
    assert ids == sorted(i or 0 for i, _ in odd_rows)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(documents, per_row, name):
    assert per_row[name](documents([])).count() == 0


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_and_empty_tables(spark, documents, odd_rows, labels, tmp_path, name):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = documents(odd_rows)
    out = stage(spark, docs, str(tmp_path))
    assert out.count() > 0
    if name != "packing":
        assert out.columns == docs.columns
        assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    assert stage(spark, documents([]), str(tmp_path)).count() == 0


def test_runs_of_few_words():
    """Texts of 0 to 6 words, alone and together."""
    few = [" ".join(["Hello", "there", "you", "and", "me", "too"][:n]) for n in range(7)]
    together, doc = textkit.Words([t.encode() for t in few]).ngrams(5)
    for n, text in enumerate(few):
        alone = textkit.Words([text.encode()]).ngrams(5)[0]
        assert len(alone) == (n > 0) + (n > 5) and alone.tolist() == together[doc == n].tolist()


@pytest.mark.parametrize("name", ("near", "quality", "substring", "toxicity", "license"))
def test_few_words_alone_in_a_partition(spark, documents, per_row, name):
    long = " ".join(f"w{i}" for i in range(150_000))
    few = [" ".join(["Hello", "there", "you", "and", "me", "too"][:n]) for n in range(7)]
    rows = [(i, text) for i, text in enumerate(few)] + [(10 + i, x) for i, text in enumerate(few) for x in (long, text)]
    docs = documents(rows).repartitionByRange(24, "doc_id")
    assert per_row[name](docs).count() == len(rows)


def test_exact_decisions(documents, odd_rows):
    got = {r.doc_id: r for r in exact_dedup.decide(documents(odd_rows)).collect() if r.doc_id}
    assert (got[5].kept, got[5].group_size, got[6].keep_id, got[7].keep_id, got[7].kept) == (True, 4, 5, 5, False)
    assert (got[1].keep_id, got[2].keep_id, got[3].keep_id) == (1, 1, 3)
    assert exact_dedup.drop_copies(documents([(1, "x"), (1, "x"), (2, "x"), (None, "y"), (None, "y")])).count() == 2


def test_near_join_decisions(documents, odd_rows):
    got = {r.doc_id: r for r in near_join.join(documents(odd_rows)).collect() if r.doc_id}
    assert (got[5].n_links, got[6].class_id, got[7].class_id, got[7].kept) == (3, 5, 5, False)
    assert (got[9].class_id, got[9].n_links, got[11].class_id, got[11].n_links) == (8, 1, 4, 1)
    assert [(got[i].class_id, got[i].n_links, got[i].kept) for i in (1, 2, 3, 12)] == [(i, 0, True) for i in (1, 2, 3, 12)]
    left = near_join.one_of_each(documents(odd_rows))
    assert sorted(r.doc_id for r in left.collect() if r.doc_id) == [1, 2, 3, 4, 5, 8, 10, 12]


def test_near_copies_with_null_and_repeated_ids(documents):
    base = [f"w{i}" for i in range(60)]
    text = {k: " ".join([f"{k}{i}" for i in range(60)]) for k in "abcde"}
    near = " ".join([*base[:59], "x"])
    nulls = [" ".join(["n", *(f"n{i}" for i in range(60)), f"end{k}"]) for k in range(3)]
    rows = [(1, " ".join(base)), (None, near), (None, text["a"]), (None, text["b"]), (None, None), (None, " "),  # one near copy
            (7, near.upper()), (7, text["c"]), (7, ""),  # an id that unlike texts share
            (9, text["d"]), (9, text["d"].upper()), (9, text["d"] + " y"),  # near copies under one id
            *[(None, n) for n in nulls], (None, nulls[0].upper()),  # a class without any id
            (11, text["e"])]
    left = [(r.doc_id, r.text) for r in near_join.one_of_each(documents(rows)).collect()]
    for row in ((1, " ".join(base)), (None, text["a"]), (None, text["b"]), (None, None), (None, " "), (7, text["c"]), (7, ""),
                (11, text["e"])):
        assert left.count(row) == 1, row
    assert [i for i, t in left if t and t.lower().startswith("d0 ")] == [9]
    assert [i for i, t in left if t and t.lower().startswith("n n0 ")] == [None]
    assert len(left) == 10


def test_packing_odd_rows(documents, odd_rows):
    out = packing.pack(documents(odd_rows), byte_bpe.encoder(BYTES)).collect()
    assert sum(r.length for r in out if r.doc_id == 1) == 1
    assert sum(r.length for r in out if r.doc_id is None) == 1 + sum(
        r.length for r in out if r.doc_id is None and r.doc_tokens > 1)
    assert packing.pack(documents([]), byte_bpe.encoder(BYTES)).count() == 0


def test_html_odd_rows(spark):
    pages = spark.createDataFrame([(1, None), (2, ""), (3, "x"), (None, "<p>y"), (4, "<" * 5000), (5, "<div>" * 3000 + "z")],
                                  "page_id long, html string").withColumnRenamed("page_id", "node")
    assert [r.text for r in html_render.extract(pages).collect()] == ["", "", "x", "y", "<" * 5000, "z"]
    assert html_render.extract(pages.limit(0)).count() == 0


def test_vectors_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, None, 1), (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1),
            (7, [inf, 1.0], 1), (8, [], 1), (9, [1.0, 0.0], None), (None, [1.0, 0.0], 1), (10, [1.0, 0.0, 0.0], 1), (1, [1.0, 0.0], 1),
            (11, [-0.0, 1.0], 1), (12, [0.0, 1.0], 1), (13, [1e-30, 0.0], 1)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr(
        "*", "'x' AS node", "'y' AS v", "1 AS keys", "2 AS copies")
    got = sorted(((r.vec_id or 99), r.n_links, r.component_id) for r in vector_dedup.dedup(vectors).collect())
    assert got == sorted([(1, 4, 1), (1, 4, 1), (2, 4, 1), (13, 4, 1), (99, 4, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 0, 6),
                          (7, 0, 7), (8, 0, 8), (9, 0, 9), (10, 0, 10), (11, 1, 11), (12, 1, 11)])
    assert vector_dedup.dedup(vectors.limit(0)).count() == 0


def test_labels_and_numbers_stay_apart(spark):
    rows = [(1, [2.0], "a,1.0"), (2, [1.0, 2.0], "a"), (3, [1.0], 'a","v":[1.0'), (4, [1.0, 1.0], "a"), (5, [3.0], "a,1.0"), (6, [2.0, 4.0], "a")]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in vector_dedup.dedup(vectors).collect())
    assert got == [(1, 1, 1), (2, 1, 2), (3, 0, 3), (4, 0, 4), (5, 1, 1), (6, 1, 2)]
