import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def spark():
    from roamkit.session import local_session
    yield local_session(cores="*", shuffle_partitions=4, app="roamkit-llm-tests")


LONG = " ".join(f"word{k % 700} idiot" for k in range(6000))
#: doc_id, text, lang, source: NULLs in any column, empty and very long texts, ties and repeated rows.
EDGES = [(1, "the same text of more than five words here", "en", "a"), (2, "the same text of more than five words here", "en", "a"), (2, "the same text of more than five words here", "en", "a"),
         (3, None, "en", "a"), (4, "", None, None), (5, "   \n\t ", "de", None), (6, LONG, "en", "b"), (7, LONG + " tail", "en", "b"), (None, "no id but password=ab12cd34ef56ab78 in it", "en", "a"),
         (8, "Σ <|endoftext|> İ 漢字 \x1c odd\x00 é", "xx", "c")]


@pytest.fixture(scope="session")
def edges(spark):
    """The edge rows, with columns whose names the operators use inside."""
    from pyspark.sql import functions as F
    docs = spark.createDataFrame(EDGES, "doc_id long, text string, lang string, source string")
    return docs.withColumns({c: F.lit("x") for c in ("score", "words", "id", "class", "bucket", "digest", "key", "shard", "size", "length", "piece", "g", "d2", "kept", "ids", "label", "path", "candidate", "start")})


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(k, k % 2, k % 3 % 2) for k in range(1, 9)] + [(None, 1, 1), (1, None, None), (1, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
