import pytest

#: Column names that operators use inside; extra columns of these names must not disturb them.
CLASHING = ("id", "node", "path", "gray", "f0", "block", "size", "shard", "rank", "bucket", "length", "score", "component", "text_hash", "n")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with clashing extra columns."""

    def make(rows):
        kind = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
        full = [(i, t, "en", "s", None if t is None else len(t), *["x"] * len(CLASHING)) for i, t in rows]
        return spark.createDataFrame(full, kind).repartition(3)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, a very long text, ties and repeated rows."""
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    return [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (3, None), (4, ""), (5, " \n\t "), (6, long), (7, "x" * 20_000), (8, "日本語 テキスト 🙂"), (None, "null id"), (None, None), (9, "A B C d e F")]
