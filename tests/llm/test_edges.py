"""Every operator and stage over odd rows and empty tables; clashing columns throughout."""

import pytest

import corpus_pipeline
from quarry.llm import (decontaminate, jaccard_join, piece_codec, pii, quality_gam, quality_rules,
                        secret_scan, simhash, suffix_index, token_count, url_filter)
from quarry.llm.queries import model_path

from .conftest import ODD

BENCH = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"), (2, None),
         (None, "nothing"), (3, ""), (4, "too short")]


def _benchmark(spark):
    return spark.createDataFrame(BENCH, "item_id bigint, text string")


def _labels(spark):
    return spark.createDataFrame([(4, 1), (6, 0), (7, 1), (None, 1), (9, None)],
                                 "doc_id bigint, quality int")


RUNS = {
    "op2": lambda s, d, x: decontaminate.find_contamination(d, _benchmark(s)),
    "op3": lambda s, d, x: secret_scan.secret_digest(d),
    "op4": lambda s, d, x: piece_codec.encode(d, model_path()),
    "op5": lambda s, d, x: quality_gam.classify(d, _labels(s), x),
    "op6": lambda s, d, x: token_count.count_tokens(d, model_path()),
    "op7": lambda s, d, x: pii.find_personal_data(d, x),
    "op8": lambda s, d, x: quality_rules.quality_rules(d, _labels(s).filter("quality = 1")),
    "op9": lambda s, d, x: suffix_index.dedup_bytes(d, x),
    "op10": lambda s, d, x: jaccard_join.near_duplicates(d, x),
    "op12": lambda s, d, x: simhash.near_duplicates(d, x),
}


@pytest.mark.parametrize("name", RUNS)
def test_odd_rows_keep_one_result_each(spark, scratch, frame, name):
    out = RUNS[name](spark, frame(ODD), scratch).collect()
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(i) for i, _ in ODD)
    twice = [r for r in out if r["doc_id"] == 7]
    assert twice[0] == twice[1]


@pytest.mark.parametrize("name", RUNS)
def test_empty_table_gives_no_rows(spark, scratch, frame, name):
    assert RUNS[name](spark, frame([(1, "a")]).filter("false"), scratch).count() == 0


def test_defined_results_of_odd_rows(spark, scratch, frame):
    docs = frame(ODD)
    by = lambda df: {(r["doc_id"]): r for r in df.collect()}
    tokens = by(token_count.count_tokens(docs, model_path()))
    assert [(tokens[i].n_bytes, tokens[i].n_tokens) for i in (1, 2)] == [(0, 0), (0, 0)]
    near = by(jaccard_join.near_duplicates(docs, scratch))
    assert [(near[i].n_shingles, near[i].component_id) for i in (1, 2, 3, 4)] == [
        (0, 1), (0, 2), (0, 3), (1, 4)]
    cut = by(suffix_index.dedup_bytes(docs, scratch))
    assert (cut[8].n_removed, cut[8].n_spans) == (49_999, 1)
    assert cut[None].n_removed == 0
    found = by(pii.find_personal_data(docs, scratch))
    assert found[9].spans == "email:0:8,ip:53:61,card:31:50,phone:11:28"
    judged = by(quality_rules.quality_rules(docs, _labels(spark).filter("false")))
    assert judged[1].n_words == 0 and judged[1].base_failed and not judged[1].kept
    assert judged[6].n_repeat_words == judged[6].n_words == 65_000


def _write(spark, tmp, docs):
    docs.write.parquet(f"{tmp}/documents.parquet")
    _benchmark(spark).write.parquet(f"{tmp}/benchmark.parquet")
    _labels(spark).write.parquet(f"{tmp}/labels.parquet")


@pytest.mark.parametrize("empty", [False, True])
def test_stages_take_odd_rows_and_empty_tables(spark, frame, tmpdir_path, empty):
    docs = frame(ODD)
    docs = docs.filter("false") if empty else docs
    _write(spark, tmpdir_path, docs)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, tmpdir_path)
        assert out.columns == docs.columns, name
        assert out.count() <= docs.count()
    assert corpus_pipeline.run(spark, tmpdir_path).columns == ["doc_id", "ids", "n_tokens", "round_trip"]


def test_url_filter_edges(spark):
    captures = spark.createDataFrame(
        [(1, "http://a.b.example.com/x", 100, "l"), (2, None, 100, "l"), (3, "no url", 100, "l"),
         (None, "https://EXAMPLE.com:80/", 100, "l"), (4, "http://example.com/", None, "l"),
         (1, "http://a.b.example.com/x", 100, "l")],
        "page_id bigint, url string, fetched_at bigint, lists string")
    entries = spark.createDataFrame(
        [("bad", "example.com", "add", 50), ("bad", "example.com", "remove", 150),
         ("allow", "b.example.com", "add", 100), ("x", None, "add", 1), ("y", "com", "add", 1)],
        "list_name string, domain string, action string, at bigint")
    rows = {(r.page_id, r.host): (r.lists, r.blocked)
            for r in url_filter.active_lists(captures, entries).collect()}
    assert rows == {(1, "a.b.example.com"): ("allow,bad", False), (2, ""): ("", False),
                    (3, ""): ("", False), (None, "example.com"): ("bad", True),
                    (4, "example.com"): ("", False)}
    assert url_filter.active_lists(captures.filter("false"), entries).count() == 0
    assert url_filter.active_lists(captures, entries.filter("false")).filter("blocked").count() == 0
