import pytest

from recordloom.llm.texts import prepare

LONG = " ".join(f"w{i % 700}" for i in range(20_000))
ODD = [
    None, "", "   ", "\n\n", "a", "One two three.", "one two THREE.", "a\x1cb c\x85d e f g h i",
    "Ünïcödé wörds, ſtrange K signs İ and Σ at the end Σ. 漢字 かな", "x" * 30_000, LONG, LONG + " end",
    "tab\tand\x0bfeed\x0c here\r\nnext line.", "😀 😀 😀 😀 😀 😀",
]


def odd_rows():
    """Odd texts, a repeated row, a repeated id, a NULL id and NULL sources."""
    rows = [(i, text, None if i % 4 == 0 else f"s{i % 3}") for i, text in enumerate(ODD)]
    return [*rows, rows[5], (6, "another text under a used id", "s1"), (None, "no id at all", None)]


@pytest.fixture(scope="session")
def make(spark):
    """A documents table, with more columns whose names the operators use inside."""
    prepare(spark)
    clash = "size bigint, key string, copies int, kept boolean, ids string, spans string, place string, shard string, " \
        "slot int, score double, target double, row bigint, part int, block string, gram bigint, n int, window string"

    def build(rows):
        n = len(clash.split(","))
        full = [(*row, None, None, *([None] * n)) for row in rows]
        schema = f"doc_id bigint, text string, source string, lang string, n_chars bigint, {clash}"
        return spark.createDataFrame(full, schema)

    return build


@pytest.fixture(scope="session")
def odd(make):
    return make(odd_rows())


@pytest.fixture(scope="session")
def nothing(make):
    return make([])
