import pytest

#: names that the operators use inside or return, as extra columns of the input
CLASHING = ["fp", "row", "id", "mark", "spans", "__fp", "__row", "key", "score", "n_words", "tokens", "label", "text_"]


@pytest.fixture
def docs_of(spark):
    """A table of (doc_id, text, lang) with null-able cells and extra columns of clashing names."""

    def make(rows, extra=True):
        rows = [tuple(r) + (None,) * (3 - len(r)) for r in rows]
        df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
        if extra:
            from pyspark.sql import functions as F

            df = df.select("*", *[F.lit(f"extra-{i}").alias(c) for i, c in enumerate(CLASHING)])
        return df

    return make


@pytest.fixture(scope="session")
def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def library(vocabulary):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary)
