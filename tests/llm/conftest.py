from __future__ import annotations

import pytest
from pyspark.sql import functions as F

FIELDS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i * i % 997}" for i in range(30_000))
CHAT = "Two roads met in a wood and the one less worn was taken by a traveller who wrote it all down later on"

#: Cases beyond the stored documents: nulls, empty and very long texts, ties, repeated rows, other alphabets.
ODD = [
    (None, f"{CHAT} without a number", None, None, None),
    (100_001, None, "en", "src1", None),
    (100_002, "", None, "src1", 0),
    (100_003, "   \n\t ", "en", None, 6),
    (100_004, "12 345 !!", "en", "src0", 9),
    (100_005, LONG, None, "src2", None),
    (100_006, LONG + " tail", None, "src2", None),
    (100_007, f"{CHAT} again", "en", None, None),
    (100_007, f"{CHAT} again", "en", None, None),
    (100_008, f"{CHAT}\n{CHAT}\n{CHAT}", "en", "src3", None),
    (100_009, "ab" * 400, "xx", "src3", None),
    (100_010, "go " * 300, "xx", "zz", None),
    (100_011, "x" * 450, None, "zz", None),
    (100_012, "你好 世界 ÉTÉ \U0001f600\U0001f600 one two", None, "\U0001f600", None),
    (100_013, "only three words", "en", "￮", None),
    (100_013, "only three other", "en", "￮", None),
    (100_014, "Only THREE words", "en", "￮", None),
    (100_015, "no no no no no no no no no no no no no no no no no no", "en", "zz", None),
    (100_016, "Released under the MIT License.\n\nplain text after it", "en", "zz", None),
    (100_017, "# * $ % & | < > a b", "en", "zz", None),
]


@pytest.fixture(scope="session")
def corpus(spark, folder):
    """The stored documents and the odd ones, with columns whose names the operators use inside."""
    stored = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    clashing = {c: F.lit(c) for c in ("row", "version", "kept", "runs", "score", "words", "size", "id", "seeds", "v1", "place")}
    docs = stored.unionByName(spark.createDataFrame(ODD, FIELDS)).withColumns(clashing)
    return docs.repartition(3).cache()


@pytest.fixture(scope="session")
def rows(corpus):
    return [(r.doc_id, r.text) for r in corpus.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def none(corpus):
    """The same columns without a row."""
    return corpus.where("false")
