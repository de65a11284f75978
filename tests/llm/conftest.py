from __future__ import annotations

import pytest

from meterlake.llm.common import let_workers_import


@pytest.fixture(autouse=True)
def _importable(spark):
    let_workers_import(spark)


@pytest.fixture
def documents(spark):
    """``documents([(doc_id, text), …])``: a table with columns that clash with inner names."""

    def make(rows, **more):
        schema = (
            "doc_id long, text string, lang string, source string, n_chars long, "
            "key string, rest int, node string, row string, shard int, found string, "
            "stretch int, place int, unit string, sha string, kind string, first string"
        )
        filled = [
            (doc_id, text, "en", "src", None if text is None else len(text), "k", 1, "n", "r", 2,
             "f", 3, 4, "u", "s", "t", "x")
            for doc_id, text in rows
        ]
        return spark.createDataFrame(filled, schema)

    return make




def regular(one, other, length, between=""):
    """A Thue-Morse sequence of two units, which collides with its complement in running sums."""
    return between.join(other if bin(i).count("1") % 2 else one for i in range(length))


#: Null id, null and empty texts, repeated rows, a repeated id, ties, a long text, odd characters.
CASES = [
    (None, "without an id"),
    (None, None),
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "a"),
    (5, "a b  c\nd"),
    (5, "a b  c\nd"),
    (5, "another text with the same id"),
    (6, "a b c d"),
    (7, "Größe 😀     naïve <|endoftext|> it's we'll 123 ½ \x00 x"),
    (8, "word " * 30_000),
    (9, "word " * 30_000),
    (10, "x" * 50_000),
    (11, regular("a", "b", 1024)),
    (12, regular("b", "a", 1024)),
    (13, regular("a", "b", 2048, " ")),
    (14, regular("b", "a", 2048, " ")),
    (15, " ".join([regular("a", "b", 1024)] * 60)),
    (16, " ".join([regular("b", "a", 1024)] * 60)),
]
