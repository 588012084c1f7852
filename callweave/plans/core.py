"""Named queries over the test tables for what the core holds, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callweave.functions.text import strip
from callweave.functions.url import canonical_url
from callweave.operators.packed import unpack
from callweave.operators.snapshots import diff_snapshots
from callweave.plans import reference
from callweave.tables import load


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls added, removed or changed between consecutive full listings of a source."""
    status = F.lower(strip(F.col("status")))
    found = diff_snapshots(load(spark, sf_dir, "call_snapshots"), "source_key", "snapshot_no", canonical_url(F.col("url")), [status, F.col("deadline").cast("string")], "loaded_at")
    return found.select("snapshot_no", F.col("key").alias("url_key"), "change_kind")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One keyword a row with its position in the record."""
    return unpack(load(spark, sf_dir, "raw_records"), "record_id", "publisher_keywords")


_SNAPSHOTS = f"""WITH r AS (SELECT source_key, snapshot_no, {reference._url_sql('url')} AS k, lower({reference._collapse('status')}) AS st, deadline, loaded_at FROM call_snapshots WHERE url IS NOT NULL),
 l AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY source_key, snapshot_no, k ORDER BY loaded_at DESC NULLS LAST, st DESC NULLS LAST, deadline DESC NULLS LAST) = 1),
 s AS (SELECT source_key, snapshot_no, lag(snapshot_no) OVER (PARTITION BY source_key ORDER BY snapshot_no) AS before, lead(snapshot_no) OVER (PARTITION BY source_key ORDER BY snapshot_no) AS after FROM (SELECT DISTINCT source_key, snapshot_no FROM l)),
 n AS (SELECT l.source_key, l.snapshot_no, l.k, l.st, l.deadline FROM l JOIN s USING (source_key, snapshot_no) WHERE s.before IS NOT NULL),
 o AS (SELECT l.source_key, s.after AS snapshot_no, l.k, l.st, l.deadline FROM l JOIN s USING (source_key, snapshot_no) WHERE s.after IS NOT NULL)
 SELECT snapshot_no, k AS url_key, CASE WHEN o.y IS NULL THEN 'added' WHEN n.x IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
 FROM (SELECT *, true AS x FROM n) n FULL JOIN (SELECT *, true AS y FROM o) o USING (source_key, snapshot_no, k) WHERE n.x IS NULL OR o.y IS NULL OR n.st IS DISTINCT FROM o.st OR n.deadline IS DISTINCT FROM o.deadline"""
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"p3_found": p3_found, "p5_found": p5_found} | reference.QUERIES
ORACLE: dict[str, str] = {"p3_found": _SNAPSHOTS} | reference.ORACLE
