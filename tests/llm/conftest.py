import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, row string, size string"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, and extra columns with clashing names."""
    long_text = " ".join(f"word{i} the and of" for i in range(30_000))
    rows = [
        (1, "The cat sat on the mat and then it ran away", "en", "a", 5, "x", "y", "z"),
        (2, "The cat sat on the mat and then it ran away", "en", "a", 5, "x", "y", "z"),
        (2, "The cat sat on the mat and then it ran away", "en", "a", 5, "x", "y", "z"),
        (3, None, "en", "b", None, None, None, None),
        (4, "", "fr", "b", 0, "", "", ""),
        (5, " \t\n ", None, None, 4, "x", "y", "z"),
        (6, long_text, "en", "c", len(long_text), "x", "y", "z"),
        (7, "a", None, "c", 1, "x", "y", "z"),
        (8, "1234 !!! ???", "de", "c", 1, "x", "y", "z"),
        (None, "The cat sat on the mat and then it ran away", "en", None, 5, None, None, None),
        (9, "thecatsatonthemat", "en", "a", 3, "x", "y", "z"),
        (10, "the cat sat\non the mat", "en", "a", 3, "x", "y", "z"),
        (11, "l'été <|endoftext|> \U0001f600 日本", "fr", "d", 3, "x", "y", "z"),
    ]
    return spark.createDataFrame(rows, DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def write_tables(folder, **frames):
    for name, frame in frames.items():
        frame.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture
def tables(tmp_path):
    return lambda **frames: write_tables(tmp_path, **frames)
