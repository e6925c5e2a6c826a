import random

import pytest

#: Names that the operators use themselves.
CLASHING = ["score", "lang_pred", "n_words", "signature", "digest", "node", "block", "part", "group", "size", "spans", "items", "kept", "end", "row"]

LONG = " ".join(f"word{i % 5000} of" for i in range(60_000))


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a table of documents from (doc_id, text), with other columns, some null, whose names clash."""

    def make(rows):
        columns = ", ".join(f"`{c}` string" for c in CLASHING)
        data = [(i, t, "en", *[None if k % 2 else "x" for k in range(len(CLASHING))]) for i, t in rows]
        return spark.createDataFrame(data, f"doc_id long, text string, lang string, {columns}").repartition(3)

    return make


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and blank texts, one very long text, equal texts, repeated rows, a missing id, no letters."""
    return [
        (1, "The quick brown fox jumps over the lazy dog near the old river bank today."),
        (2, None),
        (3, ""),
        (4, " \t\n\r "),
        (5, LONG),
        (6, "the QUICK brown fox jumps over the lazy dog near the old river bank today."),
        (7, "The quick brown fox jumps over the lazy dog near the old river bank today."),
        (8, "a"),
        (8, "a"),
        (9, "12345 !!! ... 67"),
        (10, "日本語のテキスト é x"),
        (None, "a text without an id"),
        (None, None),
    ]


@pytest.fixture(scope="session")
def random_texts():
    """Texts of a small vocabulary with exact and near copies."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["Alpha", "BETA", "é", "x-y", "1.5"]
    out = []
    for _ in range(70):
        text = [rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 2, 3, 5, 12, 40, 90]))]
        out.append(" ".join(text))
        for _ in range(rng.choice([0, 0, 1, 3])):
            copy = list(text)
            for _ in range(rng.choice([0, 1, 1, 2, 6])):
                if copy:
                    copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            out.append(rng.choice([" ", "  ", "\n"]).join(copy))
    rng.shuffle(out)
    return list(enumerate(out, 1000))


@pytest.fixture(scope="session")
def data():
    """A folder with the synthetic tables."""
    import os

    folder = os.environ.get("TILLFLOW_LLM_DIR", "/root/testdata/sf0.01")
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    return folder
