"""Tables with every awkward case, written as Parquet the way the operators' inputs are."""
import pytest
from pyspark.sql import functions as F

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, `_level` double, word string"


def doc_rows():
    long_text = " ".join(f"word{i % 977} and{i % 13}" for i in range(30_000))
    plain = "the house of the old man was near the river and it is said that he had many books in all of his rooms"
    rows = [
        (1, plain, "en", "b"), (2, plain, "en", "b"), (2, plain, "en", "b"), (3, plain + " today", "en", None),
        (4, None, "en", "a"), (5, "", "de", "a"), (6, " \n\t ", None, "a"), (7, "one two", "fr", "c"),
        (8, long_text, "en", "c"), (9, "x" * 50_000, None, "b"), (None, plain, None, None), (None, None, None, None),
        (10, "a b c d e f g h i j\n" * 40, "es", "c"), (11, "é́ß 日本語 \U0001f600 naïve line \x1c end", "fr", "d"),
        (12, "<|endoftext|> </s>[INST] ok", "en", "d"), (13, "### $$$ !!! ||| " * 20, "en", "d"),
    ]
    return [(i, t, lang, src, None if t is None else len(t), 1, 0.5, "extra") for i, t, lang, src in rows]


def stored(spark, tmp_path_factory, name, rows, schema):
    path = str(tmp_path_factory.mktemp("tables") / name)
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def odd_docs(spark, tmp_path_factory):
    return stored(spark, tmp_path_factory, "odd.parquet", doc_rows(), DOCS)


@pytest.fixture(scope="session")
def no_docs(odd_docs, tmp_path_factory, spark):
    path = str(tmp_path_factory.mktemp("tables") / "none.parquet")
    odd_docs.filter(F.lit(False)).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def run_query(spark, sf_dir):
    """Collected rows of a registered query, worked out once."""
    from tickloom.llm.queries import QUERIES

    made = {}

    def run(name):
        if name not in made:
            made[name] = QUERIES[name](spark, sf_dir).collect()
        return made[name]

    return run
