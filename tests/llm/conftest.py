import pytest

#: Rows that every operator has to take: nulls, empty and blank texts, ties, copies, a null id.
HARD = [
    (1, "plain words here and more of them"), (2, ""), (3, None), (4, "   \n\t "), (5, "plain words here and more of them"),
    (6, "plain words here and more of them!"), (7, "a"), (8, "Ünïcödé 😀 ﬁ ▁▁ \x1c   x"), (9, "z" * 5000), (10, "word " * 3000),
    (11, "mail me@example.com or call +1 (521) 555-2373. Card 4111 1111 1111 1111, host 10.0.0.1"), (None, "no id"), (12, "dup"), (12, "dup"),
    (13, "<s> <unk> <|endoftext|> <0x41>"), (14, "x\n\ny\r\n  z"),
]


@pytest.fixture(scope="session")
def hard(spark):
    """The hard rows, with extra columns whose names the operators use inside."""
    rows = [(i, t, "k", 0, [1], 2.0, "e") for i, t in HARD]
    return spark.createDataFrame(rows, "doc_id long, text string, key string, fp int, spans array<int>, n long, one string"
                                 .replace("n long", "n double"))


@pytest.fixture(scope="session")
def empty(hard):
    return hard.limit(0)


@pytest.fixture(scope="session")
def docs(spark, tiny):
    return spark.read.parquet(f"{tiny}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
