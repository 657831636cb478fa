import pytest

#: Names that operators use for their own columns.
CLASHING = (
    "size", "copies", "key", "block", "task", "number", "content", "bucket", "spans", "kept", "h", "lo", "n", "comp",
    "text_sha256", "slice", "rank", "d", "id", "gram", "base", "piece", "__digest",
)
LONG = "lorem ipsum dolor sit amet consectetur " * 6000
ODD = [
    (1, "one two three four five six seven", "en", "a"),
    (1, "one two three four five six seven", "en", "a"),  # a repeated row
    (2, "one two three four five six  seven\n", "en", "a"),  # equal but for white space, longer
    (3, "ONE two three four five six seven", "en", "b"),
    (4, "", "en", "b"),
    (5, None, "de", None),
    (6, " \t\n", None, None),
    (None, "text without a number at all, but with words", "fr", "c"),
    (7, LONG, "en", "c"),
    (8, "short", "en", "c"),
    (9, "Short", "xx", "\U0001F600"),
    (10, "größe ÉTÉ 漢字 😀 ok", "de", "z"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    rows = [(*row, None if row[1] is None else len(row[1])) + ("x",) * len(CLASHING) for row in ODD]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def docs_of(spark):
    def build(*texts, first=0):
        rows = [(first + i, t, "en", "s", None) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")

    return build


def by_id(df):
    found = {}
    for row in df.collect():
        found.setdefault(row["doc_id"], []).append(row)
    return found
