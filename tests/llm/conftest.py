import public_tokenizers
import pytest

from parcelmood.llm.base import prepared


@pytest.fixture(autouse=True)
def settings(spark):
    prepared(spark)


@pytest.fixture(scope="session")
def byte_vocabulary():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def word_vocabulary():
    return public_tokenizers.path("word_bpe_49k.json")


ODD = [
    None, "", " ", "\n\n", "one", "Ab  cd\tEF\x0bgh", "it's we'll x2 3½ ª", "<|endoftext|> a <|startoftext|>", "日本語 text ñandú Ünïcode",
    "\x1c\x1f\x85\xa0x", "İstanbul ǅ", "a" * 70_000, "word " * 9_000, "!!! ### 12345", "́combining é",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows, a null id, and columns with clashing names."""
    rows = [(i, t, None, "x", 1, 2) for i, t in enumerate(ODD)] + [(4, "one", "en", None, 1, 2), (None, "one", None, None, 0, 0)]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, node int, registers int"
    )


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
