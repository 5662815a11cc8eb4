"""Generated inputs: rule labels vs Python's re, codegen tokenising vs the general fan-out."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.operators.classify import DISCIPLINES, UNCLASSIFIED, label_expr
from quarry.operators.fanout import explode_clean, explode_terms, item_count

KEYWORDS = [k for kws in DISCIPLINES.values() for k in kws]
PIECES = KEYWORDS + ["Senior", "Lead", "é", "É", "x", "apis", "javas", "bios", "react.js",
                     "Back-End", "RE", "Ops", "data", "engineer", "_", "9"]
SEPARATORS = [" ", "  ", "-", ".", "/", "(", ")", "", "é", "\t", ","]


def python_label(title):
    """First label with any keyword as a whole word of the lower-cased title."""
    if not title:
        return UNCLASSIFIED
    text = title.lower()
    for label, keywords in DISCIPLINES.items():
        if any(re.search(r"\b" + re.escape(k) + r"\b", text) for k in keywords):
            return label
    return UNCLASSIFIED


@st.composite
def title(draw):
    parts = draw(st.lists(st.tuples(st.sampled_from(PIECES), st.sampled_from(SEPARATORS)),
                          min_size=0, max_size=5))
    text = "".join(p + s for p, s in parts)
    return text.upper() if draw(st.booleans()) and draw(st.booleans()) else text


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(title(), min_size=200, max_size=300))
def test_labels_match_python_re(spark, titles):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(titles)], "i int, title string")
    got = {r["i"]: r["d"] for r in df.select("i", label_expr("title").alias("d")).collect()}
    wrong = [(t, got[i], python_label(t)) for i, t in enumerate(titles)
             if got[i] != python_label(t)]
    assert not wrong, wrong[:5]


WORDS = st.sampled_from(["Python", "python", " python ", "", "  ", "SQL", "sql", "é", "É",
                         "a b", "x\ty", "Data", "data"])


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.lists(st.one_of(st.none(), WORDS), max_size=6)),
                min_size=50, max_size=120))
def test_tag_grain_and_count_match_python(spark, arrays):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], "k int, tags array<string>")
    rows = explode_clean(df, "k", "tags", "tag").collect()
    got = sorted((r["k"], r["tag"]) for r in rows)
    want = sorted({(i, w.strip(" ").lower()) for i, a in enumerate(arrays) if a
                   for w in a if w is not None and w.strip(" ") != ""})
    assert got == want
    counts = {r["k"]: r["n"] for r in df.select("k", item_count("tags").alias("n")).collect()}
    per_key = {}
    for k, _ in want:
        per_key[k] = per_key.get(k, 0) + 1
    assert counts == {i: per_key.get(i, 0) for i in range(len(arrays))}


TEXT = st.text(alphabet=st.sampled_from(list("aAbBéÉ .,\n\t-")), max_size=60)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), TEXT), min_size=50, max_size=120))
def test_codegen_terms_equal_general_fanout(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, text string")
    fast = explode_terms(df, "k", "text", "term")
    general = explode_clean(df.select("k", F.split("text", " ").alias("terms")), "k", "terms",
                            "term")
    assert sorted(fast.collect()) == sorted(general.collect())
