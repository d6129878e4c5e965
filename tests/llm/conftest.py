import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """documents from texts (or (doc_id, text, ...) rows)."""

    def build(rows, schema=SCHEMA):
        out = []
        for i, row in enumerate(rows):
            row = row if isinstance(row, tuple) else (i, row)
            out.append(tuple(row) + (None,) * (len(schema.split(",")) - len(row)))
        return spark.createDataFrame(out, schema).repartition(3)

    return build


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, short, repeated and long texts."""
    long_text = " ".join(f"w{i % 701}" for i in range(30_000))
    return [None, "", " \n\t ", "one", "é", "two words", "same text here " * 9, "same text here " * 9, long_text, "a|b\n\na|b\nx"]
