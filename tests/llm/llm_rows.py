import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n, vocabulary=400):
    """Deterministic words: a linear congruence over an invented vocabulary."""
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append("w" + "abcdefghij"[x // 7 % 10] + str((x >> 8) % vocabulary))
    return out


def hard_rows():
    """Nulls in any column, empty and blank and very long texts, ties and repeated rows."""
    long = " ".join(prose(1, 30_000))
    base = " ".join(prose(2, 120))
    return [
        (1, base, "en", "a", 1), (1, base, "en", "a", 1), (2, base, "en", "b", None), (3, None, "en", "a", 0),
        (4, "", None, "b", 0), (5, " \t\n", "en", None, 3), (None, base, "en", "a", 1), (6, long, "fr", "c", 9),
        (7, "one", "fr", "c", 3), (8, "one", None, None, 3), (9, "###  123 !!", "en", "b", 2), (10, "x y z", "de", None, None),
        (11, "ßİé \x85\xa0 ẞ", "de", "é", 5),
    ]


@pytest.fixture
def hard(spark):
    """The hard rows with extra columns named like the operators' own."""
    df = spark.createDataFrame(hard_rows(), DOC_SCHEMA)
    extra = ("score", "size", "taken", "spans", "rank", "n_words", "predicted", "node", "comp", "key", "kept_text", "selected")
    return df.selectExpr("*", *[f"'own' as {c}" for c in extra])


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture
def docs(spark):
    return lambda rows: spark.createDataFrame(
        [(i, t, "en", "a", len(t) if t is not None else None) for i, t in rows], DOC_SCHEMA)
