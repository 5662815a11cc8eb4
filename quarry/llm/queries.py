"""The operators of this package over the driver's tables, with SQL where it can say it.

Each query reads whole tables and returns its operator's full result. Operators
that keep intermediate tables store them below ``spark.checkpoint.dir`` and remove
them before the query returns; its rows are then a reliable checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontaminate, divergence, jaccard_join, piece_codec, pii, quality_gam, quality_rules,
               secret_scan, simhash, spelling, suffix_index, token_count, url_filter)
from ._columns import table
from ._scratch import Scratch

MODEL = "piece_bpe_32k.model"
# Texts are long: this many rows per Arrow batch bound a Python worker's memory.
ARROW_ROWS = "256"

Query = Callable[[SparkSession, str], DataFrame]


def configure(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark


def model_path() -> str:
    return str(public_tokenizers.path(MODEL))


# Captures and list edits are both read off ``pages``: a page's id gives the time of
# its fetch, and each page is also one dated edit about its host (or the host's
# parent), put on a list by its name and number.
EPOCH, MONTH = 1_704_067_200, 2_592_000
FETCHED = f"{EPOCH} + (page_id * 7919) % {MONTH}"
EDITED = f"{EPOCH} + (page_id * 104729) % {MONTH}"


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = configure(spark) and table(spark, sf_dir, "pages").select("page_id", "url")
    host = url_filter.host_of(F.col("url"))
    number = F.coalesce(F.regexp_extract("url", r"/([0-9]+)", 1).try_cast("bigint"), F.lit(0))
    labels = F.size(F.split(host, r"\."))
    entries = pages.select(
        F.when(host.contains("adult"), "adult")
        .when(host.contains("pills") | host.contains("casino"), "spam")
        .when(number % 4 == 0, url_filter.ALLOW_LIST).otherwise("malware").alias("list_name"),
        F.when((F.col("page_id") % 3 == 0) & (labels > 3),
               F.regexp_replace(host, r"^[^.]*\.", "")).otherwise(host).alias("domain"),
        F.when(number % 3 == 0, "remove").otherwise("add").alias("action"),
        F.expr(EDITED).alias("at"))
    captures = pages.withColumn("fetched_at", F.expr(FETCHED))
    return url_filter.active_lists(captures, entries)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark) and table(spark, sf_dir, "documents")
    return decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digest(configure(spark) and table(spark, sf_dir, "documents"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark) and table(spark, sf_dir, "documents")
    return piece_codec.encode(docs, model_path())


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark) and table(spark, sf_dir, "documents")
    with Scratch(spark, "op5") as scratch:
        return scratch.keep(quality_gam.classify(docs, table(spark, sf_dir, "labels"), scratch))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark) and table(spark, sf_dir, "documents")
    return token_count.count_tokens(docs, model_path())


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark) and table(spark, sf_dir, "documents")
    with Scratch(spark, "op7") as scratch:
        found = pii.find_personal_data(docs, scratch)
        return scratch.keep(found.drop("__key", "__size"))


def trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the trusted target: documents labelled as good."""
    return table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark) and table(spark, sf_dir, "documents")
    return quality_rules.quality_rules(docs, trusted(spark, sf_dir))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark) and table(spark, sf_dir, "documents")
    with Scratch(spark, "op9") as scratch:
        return scratch.keep(suffix_index.dedup_bytes(docs, scratch))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark) and table(spark, sf_dir, "documents")
    with Scratch(spark, "op10") as scratch:
        return scratch.keep(jaccard_join.near_duplicates(docs, scratch))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark) and table(spark, sf_dir, "documents")
    with Scratch(spark, "op11") as scratch:
        return scratch.keep(spelling.variants(docs, scratch))


def op12_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark) and table(spark, sf_dir, "documents")
    with Scratch(spark, "op12") as scratch:
        return scratch.keep(simhash.near_duplicates(docs, scratch))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark) and table(spark, sf_dir, "documents")
    with Scratch(spark, "op13") as scratch:
        return scratch.keep(divergence.audit(docs, scratch))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_url_filters, op2_decontamination, op3_secret_scans, op4_sentencepiece,
    op5_quality_classifier, op6_token_counts, op7_personal_data, op8_quality_rules,
    op9_suffix_dedup, op10_jaccard_join, op11_spelling_variants, op12_simhash_dedup,
    op13_source_divergence)}

SQL: dict[str, str] = {
    "op1_url_filters": f"""
        WITH p AS (
            SELECT page_id, {FETCHED} AS fetched_at, {EDITED} AS edited_at,
                   lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host,
                   coalesce(try_cast(regexp_extract(url, '/([0-9]+)', 1) AS BIGINT), 0) AS number
            FROM pages),
        edits AS (
            SELECT list_name, domain, edited_at, max(action) AS action FROM (
                SELECT CASE WHEN host LIKE '%adult%' THEN 'adult'
                            WHEN host LIKE '%pills%' OR host LIKE '%casino%' THEN 'spam'
                            WHEN number % 4 = 0 THEN 'allow' ELSE 'malware' END AS list_name,
                       CASE WHEN page_id % 3 = 0 AND len(string_split(host, '.')) > 3
                            THEN regexp_replace(host, '^[^.]*\\.', '') ELSE host END AS domain,
                       CASE WHEN number % 3 = 0 THEN 'remove' ELSE 'add' END AS action, edited_at FROM p)
            GROUP BY list_name, domain, edited_at),
        spans AS (
            SELECT *, lead(edited_at) OVER (PARTITION BY list_name, domain ORDER BY edited_at) AS until FROM edits),
        c AS (SELECT DISTINCT page_id, host, fetched_at FROM p),
        hits AS (
            SELECT DISTINCT c.page_id, c.host, c.fetched_at, s.list_name
            FROM c JOIN spans s ON (c.host = s.domain
                 OR (ends_with(c.host, '.' || s.domain) AND s.domain LIKE '%.%'))
            WHERE s.action = 'add' AND s.edited_at <= c.fetched_at
              AND (s.until IS NULL OR c.fetched_at < s.until))
        SELECT c.page_id, c.host, c.fetched_at, count(h.list_name) AS n_active,
               coalesce(string_agg(h.list_name, ',' ORDER BY h.list_name), '') AS lists,
               count(h.list_name) > 0 AND NOT coalesce(bool_or(h.list_name = 'allow'), false) AS blocked
        FROM c LEFT JOIN hits h USING (page_id, host, fetched_at)
        GROUP BY c.page_id, c.host, c.fetched_at""",
    "op10_jaccard_join": """
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
        s AS (
            SELECT DISTINCT doc_id, CASE WHEN len(ws) < 4 THEN array_to_string(ws, ' ')
                   ELSE array_to_string(ws[i:i + 3], ' ') END AS g
            FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i
                  FROM w WHERE len(ws) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        shared AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
            FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
        links AS (
            SELECT a, b FROM shared JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
            WHERE 100 * k >= 85 * (na.n + nb.n - k)),
        reach AS (
            SELECT doc_id, doc_id AS other FROM n
            UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
        SELECT d.doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles,
               coalesce(min(r.other), d.doc_id) AS component_id
        FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN reach r USING (doc_id)
        GROUP BY d.doc_id""",
    "op9_suffix_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        win AS (
            SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS w
            FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS i FROM d)),
        later AS (
            SELECT doc_id, i FROM (
                SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS k FROM win)
            WHERE k > 1),
        islands AS (
            SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (
                SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100
                                       THEN 0 ELSE 1 END AS fresh FROM later)),
        gone AS (SELECT doc_id, run, min(i) AS low, max(i) + 100 AS high FROM islands GROUP BY 1, 2),
        edges AS (
            SELECT doc_id, low, high,
                   coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS since FROM gone),
        kept AS (
            SELECT doc_id, string_agg(piece, '' ORDER BY low) AS h FROM (
                SELECT e.doc_id, e.low, substr(d.h, 2 * since + 1, 2 * (low - since)) AS piece
                FROM edges e JOIN d USING (doc_id)
                UNION ALL
                SELECT g.doc_id, max(g.high), substr(any_value(d.h), 2 * max(g.high) + 1)
                FROM gone g JOIN d USING (doc_id) GROUP BY g.doc_id)
            GROUP BY doc_id),
        sums AS (SELECT doc_id, sum(high - low) AS r, count(*) AS s FROM gone GROUP BY doc_id)
        SELECT d.doc_id, (length(d.h) // 2)::BIGINT AS n_bytes, coalesce(r, 0)::BIGINT AS n_removed,
               coalesce(s, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
        FROM d LEFT JOIN sums USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    # CRC-32 is folded byte by byte; words one letter apart are equal with that letter left out.
    "op11_spelling_variants": """
        WITH RECURSIVE bytes AS (
            SELECT list(c ORDER BY i) AS t FROM (
                SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, b: CASE WHEN c & 1 = 1
                       THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) AS r(i))),
        runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                        'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{00C0}-\\x{00FF}]+')) AS w FROM documents),
        texts AS (SELECT w, count(*) AS n, hex(encode(doc_id || ':' || w)) AS x FROM runs
                  WHERE length(w) >= 7 GROUP BY doc_id, w),
        checked AS (
            SELECT w, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(x) // 2),
                   lambda j: ('0x' || substr(x, 2 * j + 1, 2))::BIGINT)),
                   lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) AS h FROM texts, bytes),
        words AS (
            SELECT word, sum(n)::BIGINT AS n FROM (
                SELECT n, CASE WHEN h % 31 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2)
                               ELSE w END AS word FROM checked)
            WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
        cut AS (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest
                FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
        near AS (
            SELECT a.word, b.word AS other FROM cut a JOIN cut b USING (i, rest) WHERE a.word <> b.word
            UNION SELECT word, rest FROM cut WHERE rest IN (SELECT word FROM words)
            UNION SELECT rest, word FROM cut WHERE rest IN (SELECT word FROM words)),
        best AS (
            SELECT n.word, n.other, w.n, row_number() OVER (PARTITION BY n.word ORDER BY w.n DESC, n.other) AS k,
                   count(*) OVER (PARTITION BY n.word) AS n_near
            FROM near n JOIN words w ON w.word = n.other),
        known AS (
            SELECT w.word, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near,
                   CASE WHEN b.n >= 10 * w.n THEN b.other END AS form, CASE WHEN b.n >= 10 * w.n THEN b.n END AS form_n
            FROM words w LEFT JOIN best b ON b.word = w.word AND b.k = 1),
        path AS (
            SELECT word, word AS root, form FROM known
            UNION ALL SELECT p.word, k.word, k.form FROM path p JOIN known k ON k.word = p.form)
        SELECT k.word, k.form, p.root, k.n, k.n_near, k.form_n
        FROM known k JOIN path p ON p.word = k.word AND p.form IS NULL""",
    "op13_source_divergence": """
        WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
        t AS (SELECT id, lang, source, term, count(*) AS n FROM (
                SELECT id, lang, source, unnest(regexp_extract_all(text,
                       '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d)
              GROUP BY ALL),
        kept AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM t GROUP BY lang, term HAVING count(*) >= 3),
        size AS (SELECT lang, count(term)::HUGEINT AS v, coalesce(sum(kept.n), 0)::HUGEINT AS total
                 FROM (SELECT DISTINCT lang FROM d) LEFT JOIN kept USING (lang) GROUP BY lang),
        groups AS (SELECT DISTINCT lang, source FROM d),
        c AS (SELECT g.lang, g.source, k.term, coalesce(sum(t.n), 0)::HUGEINT AS n
              FROM groups g JOIN kept k USING (lang)
              LEFT JOIN t ON t.lang = g.lang AND t.source = g.source AND t.term = k.term GROUP BY ALL),
        p AS (SELECT c.lang, c.source, c.term, c.n, 1 + (1000000000 * (c.n + 1)) // (s.total + size.v) AS p
              FROM c JOIN (SELECT lang, source, sum(n)::HUGEINT AS total FROM c GROUP BY ALL) s
                     USING (lang, source) JOIN size USING (lang)),
        q AS (SELECT lang, term, 1 + (1000000000 * (n + 1)) // (total + v) AS q FROM kept JOIN size USING (lang)),
        pairs AS (SELECT g.lang, g.source, o.source AS item FROM groups g JOIN groups o
                  ON g.lang = o.lang AND g.source <> o.source),
        apart AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
                  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        found AS (
            SELECT lang, source, 'pair' AS part, item, coalesce(value, 0)::BIGINT AS value
            FROM pairs LEFT JOIN apart USING (lang, source, item)
            UNION ALL
            SELECT p.lang, p.source, 'term', p.term, (((p.p - q.q) * (p.p - q.q)) // q.q)::BIGINT
            FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q)
        SELECT * FROM (
            SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
            FROM found) WHERE part = 'pair' OR rank <= 200""",
}
