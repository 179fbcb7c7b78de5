import pytest

LONG = " ".join(f"word{i}" for i in range(30_000))
#: id, text: nulls, empty, repeated rows, repeated ids, long texts, odd characters.
MESSY = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one two three four five six seven"),
    (4, "one two three four five six seven"),
    (5, "one two three four five six seven"),
    (None, "one two three four five six seven"),
    (None, None),
    (6, "123 !!! ***"),
    (7, LONG),
    (8, LONG),
    (9, "日本語のテキスト é ß Ñ <|endoftext|> it's"),
    (10, "a"),
    (-3, "x\n\n\ny\nz\n" * 40),
]
EXTRA = "n int, did string, rid string, key string, start long, text_ string, removed_chunks int, h int, component_id long, _all int"


@pytest.fixture(scope="session")
def messy(spark):
    """The rows above, with columns that bear names the operators use inside."""
    rows = [(i, t, "en" if k % 2 else "de", *([k] * 1), "d", "r", "k", k, "t", k, k, k, k) for k, (i, t) in enumerate(MESSY)]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, {EXTRA}")


@pytest.fixture(scope="session")
def empty(messy):
    return messy.limit(0)
