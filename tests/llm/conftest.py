import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that operators use inside
    *(T.StructField(n, T.StringType()) for n in ("row", "key", "id", "content", "digest", "_text", "ids", "spans")),
])

PROSE = {
    "en": "the river of stone was in the valley and to that place a man with no name came at dusk",
    "de": "der alte Fluss und die Stadt waren von dem Nebel nicht mit dem Auge zu sehen für ein Kind",
}


@pytest.fixture(scope="session")
def docs(spark):
    """Builds a documents table from (id, text[, lang[, source]]) with clashing extra columns."""
    def make(rows):
        full = [(*row, *[None] * (4 - len(row)), len(row[1] or "") if row[1] is not None else None, *["x"] * 8)
                for row in rows]
        return spark.createDataFrame(full, DOCS)
    return make


def long_text(seed: int, n: int, lang: str = "en") -> str:
    words = PROSE[lang].split()
    return " ".join(f"{words[(i * 7 + seed * 3) % len(words)]}{(i * i + seed * 31) % 97}" for i in range(n))


#: Null, empty, blank, one word, ties and repeats, all in one table.
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "word"), (5, "word"), (None, "no id at all"), (7, "Ünïcode 日本 🎉\x1cx")]


@pytest.fixture(scope="session")
def odd():
    return ODD
