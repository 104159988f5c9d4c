import os

import pytest

SMALL = "/root/testdata/sf0.001"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

# Texts that every operator has to stand: null, empty, blank, odd signs, ties and repeats.
ODD_TEXTS = [
    None,
    "",
    " \n\t ",
    "one",
    "One two. Three four five six! Seven\neight nine ten eleven twelve.",
    "One two. Three four five six! Seven\neight nine ten eleven twelve.",
    "<|endoftext|> <|startoftext|>x<|im_end|> \\ <\\| |>",
    "日本語 テキスト。漢字 😀👍🏽 é ﬁ ΑΣ İ",
    "a  b\x1c c\x85 d e\x0b f\x0c g\r\nh",
    "x" * 5000,
    "again and " * 3000,
    "\0 null sign",
]


@pytest.fixture
def docs(spark):
    """Documents from texts, with ids in order, or from pairs of id and text."""

    def build(*rows):
        pairs = [row if isinstance(row, tuple) else (i, row) for i, row in enumerate(rows)]
        return spark.createDataFrame(
            [(i, text, "en", "s", None if text is None else len(text)) for i, text in pairs],
            DOC_SCHEMA,
        )

    return build


@pytest.fixture
def clashing():
    """The same rows with more columns, whose names operators use themselves."""

    def add(frame):
        from pyspark.sql import functions as F

        names = ("n", "ids", "word", "gram", "node", "whole_text", "block", "size", "term", "kept",
                 "score", "label", "component", "id", "tie", "window", "place")
        return frame.withColumns({name: F.lit(name) for name in names if name not in frame.columns})

    return add


@pytest.fixture(scope="session")
def small(spark):
    if not os.path.isdir(SMALL):
        pytest.skip("no test tables here")
    return SMALL
