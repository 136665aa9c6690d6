import pytest

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators use inside, as extra columns of an input.
CLASHING = (
    "row string, score double, predicted int, held_out string, words string, hashes string, _words int, _text string, "
    "set_key string, bands string, row_key int, class_id string, root string, count int, item_id string, has string, "
    "number int, size string, shard int, hits string, ids string, decoded string, _key string, _row string"
)


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs."""

    def make(pairs, extra=""):
        names = [c.split()[0] for c in extra.split(", ") if c]
        rows = [(i, t, "en", "s", len(t or "")) + (None,) * len(names) for i, t in pairs]
        return spark.createDataFrame(rows, DOC + (", " + extra if extra else ""))

    return make


@pytest.fixture
def edge_docs(docs):
    """NULLs, empty and very long texts, ties, repeated rows, and clashing extra columns."""
    long = " ".join(f"word{i}" for i in range(30_000))
    same = "one and the same text stands here twice or more"
    return docs(
        [(1, None), (2, ""), (3, "  \n"), (4, long), (5, same), (6, same), (6, same), (None, same), (None, None),
         (7, "two words"), (8, "!!! ... ???"), (9, long + " tail")],
        CLASHING,
    )
