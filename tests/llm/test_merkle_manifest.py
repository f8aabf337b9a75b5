"""The manifest against trees built by hand."""

from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tremorlake.llm import merkle_manifest


def _sha(text):
    return sha256(text.encode()).hexdigest()


def _leaf(row):
    values = [getattr(row, f) for f in merkle_manifest.FIELDS]
    return _sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def _tree(leaves):
    """Root and, for each leaf, the siblings upwards."""
    paths, at, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for k, i in enumerate(at):
            j = i + 1 if i % 2 == 0 else i - 1
            paths[k].append("" if j >= len(nodes) else ("r" if j > i else "l") + nodes[j])
        nodes, at = [_sha("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)], [i // 2 for i in at]
    return nodes[0], paths


def _by_hand(rows):
    """(doc_id, leaf, subroot, root, path) of each row."""
    groups = {}
    for r in rows:
        groups.setdefault(r.lang, []).append((r.doc_id is not None, r.doc_id or 0, _leaf(r), r.doc_id))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: _tree([leaf for _, _, leaf, _ in sorted(groups[g])]) for g in names}
    root, tops = _tree([trees[g][0] for g in names]) if names else (None, [])
    return [(row[3], row[2], trees[g][0], root, [*path, *top]) for g, top in zip(names, tops)
            for row, path in zip(sorted(groups[g]), trees[g][1])]


def _order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def _table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")


@pytest.mark.parametrize(("block_levels", "fanout_levels"), [(1, 1), (2, 2), (10, 4)])
def test_manifest_equals_trees_by_hand(spark, block_levels, fanout_levels):
    sizes = {"en": 67, "de": 16, "fr": 5, "es": 1, "": 33, None: 19, "ü": 2}
    rows = [(100 * k + i, "s", lang, i, f"text {i}") for k, (lang, n) in enumerate(sizes.items()) for i in range(n)]
    docs = _table(spark, rows[::-1])
    got = merkle_manifest.manifest(docs, block_levels=block_levels, fanout_levels=fanout_levels)
    assert _order([(r.doc_id, r.leaf, r.subroot, r.root, r.path) for r in got.collect()]) == _order(_by_hand(docs.collect()))


def test_odd_rows(spark):
    rows = [(None, None, None, None, None), (None, "s", "en", 1, ""), (1, "s", "en", 1, "x"), (1, "s", "en", 1, "x"), (1, "s", "en", 1, "y"),
            (1 << 60, "é", "en", None, "漢字 " * 50_000), (-3, "", "", 0, ""), (2, "s", "en", 1, "x")]
    docs = _table(spark, rows).selectExpr("*", "'a' AS leaf", "'b' AS grp", "1 AS place", "2 AS path", "3 AS block", "4 AS name", "5 AS root")
    for own in (docs, docs.limit(1), docs.limit(0)):
        got = merkle_manifest.manifest(own, block_levels=1, fanout_levels=1).collect()
        assert _order([(r.doc_id, r.leaf, r.subroot, r.root, r.path) for r in got]) == _order(_by_hand(own.collect()))


def test_forged_rows_are_found(spark):
    docs = _table(spark, [(i, "s", "abc"[i % 3], i, f"t{i}") for i in range(200)])
    forged = merkle_manifest.leaf([F.lit("other") if f == "text" else F.col(f) for f in merkle_manifest.FIELDS])
    claimed = F.when(F.col("doc_id") % 9 == 0, forged).otherwise(merkle_manifest.leaf([F.col(f) for f in merkle_manifest.FIELDS]))
    got = merkle_manifest.manifest(docs, claimed=claimed, block_levels=2, fanout_levels=1).select(
        "doc_id", (merkle_manifest.folded(F.col("claimed"), F.col("path")) == F.col("root")).alias("holds"))
    assert {r.doc_id: r.holds for r in got.collect()} == {i: i % 9 != 0 for i in range(200)}
