import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Names that operators use inside, as columns of a table.
CLASHING = ("key", "norm", "kept", "score", "node", "group", "a", "b", "label", "words", "id", "place", "root", "copies",
            "text_hash", "bucket", "meeting", "side", "digest", "low", "class_id", "n_links", "__hash", "__place", "__part", "__bits",
            "__node", "__key", "__gone", "__runs", "__words", "__ids", "__cut", "__id", "__keep", "__twin", "row", "cut", "runs", "twin",
            "slot", "address", "depth", "f_id", "k_id", "range", "grp", "absent", "chars", "keep_id", "__score", "__w", "__hub", "__root")


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table of (doc_id, text) rows, with further columns of clashing names."""

    def make(rows):
        frame = spark.createDataFrame(list(rows), "doc_id long, text string")
        extra = ", ".join(f"'{n}' AS {n}" for n in CLASHING)
        return frame.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source",
                                "CAST(length(text) AS BIGINT) AS n_chars", *extra.split(", "))

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Null ids and texts, empty and very long texts, ties, repeated rows."""
    long = " ".join(f"w{i % 977}x{i // 977}" for i in range(30_000))
    same = "One text, that is found in several rows of the table and has more than five words."
    return [(None, None), (None, "no id here but a text of some words"), (1, None), (2, ""), (3, " \t\n"), (4, long),
            (5, same), (6, same), (6, same), (7, same.replace(" ", "\n", 1)), (8, "word"), (9, "Word"), (10, "é ü 漢字 \x00 x"),
            (11, long + " end"), (12, "...")]
