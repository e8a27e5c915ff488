import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows, extra=False):
        df = spark.createDataFrame([(d, t, "en", s, None) for d, t, s in rows], DOC)
        if extra:  # names that operators might use themselves
            for name in ("host", "text_hash", "key", "w", "bucket", "size", "word", "root", "gone_id"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make


PROSE = [
    "the quick brown fox jumps over the lazy dog while seven small birds watch from the old stone wall beside a river that runs to the sea",
    "every morning the baker opens his shop before dawn and the smell of warm bread drifts along the narrow street to the harbour and back",
    "in the mountains of the north winter comes early and people gather wood in autumn so that no house is cold when the first snow falls",
]


@pytest.fixture(scope="session")
def prose():
    return PROSE
