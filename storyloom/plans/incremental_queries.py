"""Query of the incremental operator."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..operators.incremental import plan_fetch
from ..session import shared_dir
from .registry import query

DUE = """
with fetch_runs as (select started_at, status from run_log where stage = 'fetch'),
good as (
  select url, try_cast(fetched_at as timestamptz) seen from fetch_manifest
  where status = 200 and trim(coalesce(error, '')) = '' and url is not null
),
done as (
  select url, max(seen) done_at from (
    select g.url, g.seen, (select arg_max(r.status, r.started_at) from fetch_runs r where r.started_at <= g.seen) run_status from good g
  ) where run_status = 'success' group by url
),
days as (
  select url, max(try_strptime(case
    when regexp_matches(substr(lastmod, 1, 10), '^\\d{4}-\\d{2}-\\d{2}$') then substr(lastmod, 1, 10)
    when regexp_matches(substr(lastmod, 1, 10), '^\\d{4}-\\d{2}$') then substr(lastmod, 1, 10) || '-01'
    when regexp_matches(substr(lastmod, 1, 10), '^\\d{4}$') then substr(lastmod, 1, 10) || '-01-01' end, '%Y-%m-%d')) latest
  from discovered_urls where url is not null group by url
)
select days.url from days left join done using (url)
where done_at is null or cast(latest as date) > cast(done_at at time zone 'UTC' as date)
"""


#: Changes when what is kept of a file changes, so that no state of another kind is read.
STATE = "plan-fetch-1"


@query("p6_found", DUE)
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned on the state kept for these tables in the shared folder: the first call fills it, later ones add what is new."""
    place = hashlib.sha256(sf_dir.rstrip("/").encode()).hexdigest()[:16]
    return plan_fetch(spark, sf_dir, f"{shared_dir(spark)}/{STATE}-{place}")


@query("p6_second_run", DUE)
def p6_second_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan of a second run over the same files: its manifest holds them all, so it reads none and answers from the state."""
    state = f"{shared_dir(spark)}/{STATE}-{uuid.uuid4().hex}"
    plan_fetch(spark, sf_dir, state)
    return plan_fetch(spark, sf_dir, state)
