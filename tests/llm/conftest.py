import pytest

SMALL = "/root/testdata/sf0.001"

# nulls, empty and blank texts, ties, repeated rows, one very long text, all kinds of characters
TEXTS = [
    None,
    "",
    " \n\t ",
    "one",
    "One two three",
    "the quick brown fox jumps over the lazy dog and runs away from it",
    "The quick brown fox jumps over the lazy dog and runs away from it",
    "the quick brown fox jumps over the lazy dog and runs away from it",
    "mail bo.b+x@mail.example.org or +1 (348) 555-9642, ip 10.0.0.255, card 4111 1111 1111 1111.",
    "é漢字 😀 ▁ tab\tline\nline\n\nline\x0bvt  wide <|endoftext|> \\### Assistant: </turn> ok",
    "a" * 5000 + " 12345678901234567890 " + "." * 300,
    "word " * 3000 + "and then it stops @ nothing 1.2.3.4.5",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Edge cases with extra columns whose names clash with those the operators use inside."""
    rows = [(i, t, "en" if i % 2 else None, "src", 0, True, "x") for i, t in enumerate(TEXTS)]
    rows.append(rows[5])  # a repeated row
    rows.append((None, None, None, None, None, None, None))
    schema = "doc_id long, text string, lang string, source string, n_words int, kept boolean, hi string"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def odd_texts():
    return [t for t in TEXTS if t is not None]


@pytest.fixture(scope="session")
def empty_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
