"""The record gate agrees with a lax pydantic model of a posting on generated records.

The model is written here from FIXTURES F1 (required strings, optional
location, defaulted remote and tags, created_at as epoch seconds or any
datetime input). Each hypothesis example is one Spark job over a few hundred
records.
"""

import datetime as dt
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarry.operators.validate import gate

pydantic = pytest.importorskip("pydantic")


class Posting(pydantic.BaseModel):
    slug: str
    title: str
    company_name: str
    location: str | None = None
    remote: bool = False
    tags: list[str] = pydantic.Field(default_factory=list)
    created_at: dt.datetime

    @pydantic.field_validator("created_at", mode="before")
    @classmethod
    def _epoch(cls, value):
        if isinstance(value, int):
            return dt.datetime.fromtimestamp(value, tz=dt.UTC)
        return value


def accepted_by_model(record) -> bool:
    try:
        Posting.model_validate(record)
        return True
    except (pydantic.ValidationError, ValueError, OverflowError, OSError):
        return False


MISSING = object()
STRINGS = ["x", "", "Data Engineer", 1, 1.5, True, None, ["x"], {"a": 1}]
LOCATIONS = [None, "Amsterdam", "  ", 3, False, []]
REMOTES = [True, False, 0, 1, 2, -1, 0.0, 1.0, 0.5, None, "yes", "NO", "On", "off", "t", "F",
           "1", "0", "maybe", "", " yes", "1.0", [], {}]
TAGS = [[], ["sql"], ["sql", "Python"], ["a", None], [1], ["a", 2], "sql", None, {"a": 1},
        ["null"], ['a"b,c', "x\\"], [["a"]], [True], ["é", "😀"], [None]]
CREATED = [1786481729, 0, -1, True, False, 1786481729.5, 1.0e9, -3.25, "1786481729", "-5",
           "12.5", "2026-08-11", "2026-08-11T20:55:29Z", "2026-08-11T20:55:29.123+02:00",
           "2026-08-11 20:55", "2026-13-01", "2026-02-30", "yesterday", "", None,
           253402300799, 253402300800, -62135596800, -62135596801, 10**20, [], {"a": 1}]


def field(values):
    return st.one_of(st.just(MISSING), st.sampled_from(values))


@st.composite
def record(draw):
    kind = draw(st.sampled_from(["object"] * 8 + ["scalar", "list", "null"]))
    if kind == "scalar":
        return draw(st.sampled_from(["not-a-dict", 42, 1.5, True]))
    if kind == "list":
        return [1, "a"]
    if kind == "null":
        return None
    rec = {}
    for name, values in [("slug", STRINGS), ("title", STRINGS), ("company_name", STRINGS),
                         ("location", LOCATIONS), ("remote", REMOTES), ("tags", TAGS),
                         ("created_at", CREATED)]:
        # required fields are usually present, so most records get past them
        pool = st.sampled_from(values) if name in ("slug", "title", "company_name") and \
            draw(st.integers(0, 9)) > 1 else field(values)
        value = draw(pool)
        if value is not MISSING:
            rec[name] = value
    if draw(st.booleans()):
        rec["extra"] = {"nested": [1, 2]}
    return rec


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(record(), min_size=150, max_size=300))
def test_gate_agrees_with_pydantic(spark, records):
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)]
    df = spark.createDataFrame(rows, "i int, raw string")
    got = {r["i"]: r["accepted"] for r in gate(df).select("i", "accepted").collect()}
    wrong = [(records[i], got[i]) for i in range(len(records))
             if got[i] != accepted_by_model(records[i])]
    assert not wrong, wrong[:5]
