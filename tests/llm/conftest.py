import pytest

from quarry.llm._scratch import Scratch
from quarry.llm.queries import configure


@pytest.fixture
def scratch(spark):
    configure(spark)
    with Scratch(spark, "test") as s:
        yield s


# Columns of documents, and further ones whose names the operators use inside.
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          "key bigint, node string, score string, spans int, kept string, copy int, size int")


@pytest.fixture
def frame(spark):
    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en", "s", len(t or ""), 1, "n", "x", 2, "k", 3, 4) for i, t in rows], SCHEMA)
    return make


LONG = "word another thing " * 20_000 + "end " * 5000
ODD = [(1, None), (2, ""), (3, "   \n\t "), (4, "one"), (None, "no id here"), (5, "Ünïcode ﬁ 你好 😀 x"),
       (6, LONG), (7, "same text twice in the table"), (7, "same text twice in the table"),
       (8, "x" * 50_000), (9, "a.b@c.de x +1 (555) 555-0100 y 4111 1111 1111 1111 z 10.0.0.1")]
