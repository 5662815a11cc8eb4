"""The build's data tests: 29 column tests + 3 singular tests = 32.

``checks(build)`` lists them; ``quality.run_checks`` turns them into the
report that must show no ``fail`` before anything is published (G4).
"""

from __future__ import annotations

import datetime as dt

from ..operators import quality as dq
from .postings import Build

# Labels the enriched mart may hold.
ACCEPTED_DISCIPLINES = ("data", "backend", "frontend", "devops", "mobile", "other")


def checks(b: Build, now: dt.datetime | None = None) -> list[dq.Check]:
    out: list[dq.Check] = []
    # staging: 6
    out.append(dq.unique_check("stg_postings", b.staging, "posting_id"))
    out += dq.not_null_checks("stg_postings", b.staging,
                              ["posting_id", "title", "company_name", "is_remote", "posted_at"])
    # tag grain: 4
    out += dq.not_null_checks("int_posting_tags", b.tags, ["posting_id", "tag", "posted_at"])
    out.append(dq.relationships_check("int_posting_tags", b.tags, "posting_id", b.staging))
    # postings mart: 9
    out.append(dq.unique_check("fct_postings", b.postings, "posting_id"))
    out += dq.not_null_checks("fct_postings", b.postings,
                              ["posting_id", "title", "company_name", "is_remote", "tag_count",
                               "posted_at", "posted_date", "ingested_at"])
    # popularity mart: 5
    out.append(dq.unique_check("fct_tag_popularity", b.popularity, "tag"))
    out += dq.not_null_checks("fct_tag_popularity", b.popularity,
                              ["tag", "postings", "first_seen_at", "last_seen_at"])
    # enriched mart: 5
    out.append(dq.unique_check("fct_postings_enriched", b.enriched, "posting_id"))
    out += dq.not_null_checks("fct_postings_enriched", b.enriched,
                              ["posting_id", "discipline", "enriched_at"])
    out.append(dq.accepted_values_check("fct_postings_enriched", b.enriched, "discipline",
                                        ACCEPTED_DISCIPLINES))
    # singular: 3
    out.append(dq.grain_check("assert_one_row_per_posting_tag", b.tags, ["posting_id", "tag"]))
    out.append(dq.not_in_future_check("assert_posted_at_not_in_future", b.postings, "posted_at",
                                      now=now))
    out.append(dq.not_empty_check("assert_postings_not_empty", b.postings))
    return out
