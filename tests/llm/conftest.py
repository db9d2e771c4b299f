import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def folder(spark, tmp_path):
    """Writes tables as a scale folder and returns its path: (schema, rows) by name."""

    def write(**tables):
        for name, (schema, rows) in tables.items():
            spark.createDataFrame(rows, schema).coalesce(2).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


@pytest.fixture
def documents(folder):
    """A folder with ``documents`` of these (doc_id, text), whose columns clash with names that operators use."""

    def write(rows, extra="block long, text_b string, path string, _0 string", **tables):
        rows = [(d, t, "en", "s", len(t or ""), d, t, None, "x") for d, t in rows]
        return folder(documents=(f"{DOCUMENTS}, {extra}", rows), **tables)

    return write
