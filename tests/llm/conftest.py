import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text[, lang[, source]]) tuples, with further columns whose names the operators use."""

    def make(rows, extra=True):
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, *(None,) * (4 - len(row)))
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        df = spark.createDataFrame(full, DOCUMENTS)
        if extra:
            for name in ("row", "doc", "th", "h", "g", "key", "keys", "size", "rate", "word", "pos", "line", "component", "label", "score"):
                df = df.selectExpr("*", f"'x' as {name}")
        return df

    return make


@pytest.fixture
def tables(spark, tmp_path):
    """A folder with the given tables, to run a registered query on."""

    def make(**frames):
        for name, frame in frames.items():
            frame.write.parquet(f"{tmp_path}/tables/{name}.parquet")
        return f"{tmp_path}/tables"

    return make


