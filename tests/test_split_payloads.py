"""One payload file read by many tasks equals the file read whole."""

import json
import os
import random

import numpy as np
import pytest

from quarry.sources.landing import unwrap_payloads
from quarry.sources.split_payloads import scan, split_payloads


@pytest.fixture
def small_blocks(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}

    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield use
    for k, v in before.items():
        spark.conf.set(k, v)


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", newline="") as fh:
        fh.write(text)


def _rows(df):
    return sorted(tuple(r[c] for c in ("source_file", "position", "raw")) for r in df.collect())


def _record(rng, depth=0):
    kind = rng.randrange(8 if depth < 3 else 5)
    if kind < 2:
        return rng.choice(["}", "{[,]}", 'a"b', "back\\slash", "\\\\", "é😀", "x,y", '"data":[', ""]) * rng.randrange(3)
    if kind == 2:
        return rng.choice([1, -2.5, True, None, 10 ** 12])
    if kind < 5:
        return [_record(rng, depth + 1) for _ in range(rng.randrange(3))] if depth < 3 else 7
    return {rng.choice(["a", "data", "k\"}", "b,"]) + str(k): _record(rng, depth + 1) for k in range(rng.randrange(4))}


@pytest.mark.parametrize("size", [64, 333, 1 << 20])
def test_split_equals_whole(spark, tmpdir_path, small_blocks, size):
    rng = random.Random(size)
    for i in range(6):
        records = [_record(rng) for _ in range(40)]
        indent = rng.choice([None, 1])
        wrapped = {"meta": {"x": ["}", [1, {"data": [5]}], {}], "data ": [1, 2]}, "data": records, "z": {"n": [[3], {}]},
                   "more": [{"q": 1}, 2]}
        _write(tmpdir_path, f"p{i}.json", json.dumps(records if i % 2 else wrapped, indent=indent,
                                                     ensure_ascii=bool(i % 3)) + ("\n\n" if i > 3 else ""))
    _write(tmpdir_path, "none.json", " [ ] ")
    _write(tmpdir_path, "one.json", '{"data": [ {"a": "}"} ]}\n')
    want = _rows(unwrap_payloads(spark, tmpdir_path))
    small_blocks(size)
    got = split_payloads(spark, tmpdir_path)
    assert _rows(got) == want and len(want) == 6 * 40 + 1


def test_one_file_is_read_by_many_tasks(spark, tmpdir_path, small_blocks):
    from quarry.sources.split_payloads import payload_rows
    _write(tmpdir_path, "big.json", json.dumps([{"k": i, "t": "x" * 50} for i in range(2000)]))
    small_blocks(8192)
    rows = payload_rows(spark, tmpdir_path)
    assert rows.select("block").distinct().count() > 10 and rows.rdd.getNumPartitions() > 10
    assert split_payloads(spark, tmpdir_path).count() == 2000


@pytest.mark.parametrize("text, says", [
    ('"a"', "neither a list"), ("12", "neither a list"), ('{"items": [1]}', "neither a list"),
    ('{"data": {"a": [1]}}', "neither a list"), ('[{"a": 1}', "not whole"), ('[{"a": 1}, {"b": "x}]', "not whole"),
    ('{"data": [{"a": 1}]', "not whole"), ("[1, , 2]", "empty place"), ('[{"a": 1}, ]', "empty place"),
    ('[{"a": 1}] [2]', "goes on|neither"), ('[{"a" 1}]', "neither a list"), ('[{"a": 1} {"b": 2}]', "neither a list")])
def test_what_is_no_payload_fails_the_job(spark, tmpdir_path, small_blocks, text, says):
    _write(tmpdir_path, "bad.json", text)
    small_blocks(16)
    with pytest.raises(Exception, match=says):
        split_payloads(spark, tmpdir_path).collect()


def test_scan_follows_strings_and_escapes():
    rng = random.Random(1)
    for _ in range(300):
        text = bytes(rng.choice(b'"\\[]{},ax') for _ in range(rng.randrange(1, 30)))
        for start in (False, True):
            inside, escaped, want = start, False, []
            for c in text:
                quote = c == 0x22 and not escaped
                inside ^= quote
                want.append(not inside and not quote)
                escaped = c == 0x5C and not escaped
            outside, step, end = scan(np.frombuffer(text, np.uint8), start)
            assert outside.tolist() == want and end == inside, text
            assert step.tolist() == [(1 if c in b"[{" else -1 if c in b"]}" else 0) if o else 0
                                     for c, o in zip(text, want)]
