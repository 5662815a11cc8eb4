"""The record gate (V1-V5): good, bad, scalar, missing and lax-typed records."""

import json

from quarry.operators.validate import gate, gate_counts, rejects

from .conftest import GOOD


def _gate(spark, records):
    rows = [(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(records)]
    df = spark.createDataFrame(rows, "i int, raw string")
    return gate(df).orderBy("i").collect()


def _with(**kw):
    rec = dict(GOOD)
    for k, v in kw.items():
        if v is ...:
            rec.pop(k)
        else:
            rec[k] = v
    return rec


def test_good_record_survives(spark):
    (r,) = _gate(spark, [GOOD])
    assert r["accepted"] and r["error_count"] == 0


def test_one_bad_record_does_not_lose_the_batch(spark):
    rows = _gate(spark, [GOOD, {"slug": "missing-everything-else"}])
    assert [r["accepted"] for r in rows] == [True, False]
    assert rows[1]["identifier"] == "missing-everything-else"
    assert rows[1]["error_count"] == 3  # title, company_name, created_at


def test_scalars_are_rejected_not_fatal(spark):
    rows = _gate(spark, [GOOD, '"not-a-dict"', "42"])
    assert [r["accepted"] for r in rows] == [True, False, False]
    assert rows[1]["identifier"] == "'not-a-dict'"
    assert rows[2]["identifier"] == "42"
    assert list(rows[1]["reasons"]) == ["not_object"]


def test_missing_title_rejected(spark):
    (r,) = _gate(spark, [_with(title=...)])
    assert not r["accepted"] and list(r["reasons"]) == ["title:missing"]


def test_lax_types(spark):
    cases = [
        (_with(remote="yes"), True),
        (_with(remote="OFF"), True),
        (_with(remote=1), True),
        (_with(remote=2), False),
        (_with(remote=None), False),
        (_with(remote=...), True),
        (_with(tags=None), False),
        (_with(tags=[1]), False),
        (_with(tags=["a", None]), False),
        (_with(tags=[]), True),
        (_with(tags=...), True),
        (_with(location=None), True),
        (_with(location=3), False),
        (_with(slug=123), False),
        (_with(created_at="2026-08-11T00:00:00Z"), True),
        (_with(created_at="2026-08-11"), True),
        (_with(created_at="1786481729"), True),
        (_with(created_at=1786481729.5), True),
        (_with(created_at=True), True),
        (_with(created_at="yesterday"), False),
        (_with(created_at=None), False),
        (_with(extra_field={"x": 1}), True),
    ]
    rows = _gate(spark, [c for c, _ in cases])
    assert [r["accepted"] for r in rows] == [ok for _, ok in cases]


def test_broken_line_is_one_reject(spark):
    (r,) = _gate(spark, ['{"slug": "x", '])
    assert list(r["reasons"]) == ["not_json"]


def test_counts_and_rejects_view(spark):
    df = spark.createDataFrame([(json.dumps(GOOD),), ('"x"',), ("{",)], "raw string")
    g = gate(df)
    c = gate_counts(g).first()
    assert (c["accepted"], c["rejected"]) == (1, 2)
    assert rejects(g).count() == 2


def test_repeated_key_keeps_last_value(spark):
    raw = json.dumps(GOOD)[:-1] + ', "title": 5}'
    (r,) = _gate(spark, [raw])
    assert list(r["reasons"]) == ["title:not_string"]
