"""Not-modified revisits of a web archive, resolved to the response that they stand for. DataFrame functions only.

An as-of join by canonical URL: each revisit takes the latest earlier full response of its URL. Captures of a URL are cut
into stretches of time; inside one, a window carries the last full response forward, and a second window over one row per
stretch carries it across, so a URL with a third of all captures is no single task. Bodies are not read: whoever wants one joins it by resolved_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STRETCH = 4096
# Headers that a not-modified response may update; all others are those of the full response.
UPDATABLE = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary", "warning")


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, without user, default port, fragment, and a slash for an empty path."""
    plain = F.regexp_replace(F.trim(url), "#.*$", "")
    host = F.lower(F.regexp_extract(plain, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r"://[^@]*@", "://"), r"^(http://[^:]*):80$|^(https://[^:]*):443$", "$1$2")
    rest = F.regexp_replace(plain, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*", "")
    return F.when(host == "", plain).otherwise(F.concat(host, F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))))


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """id, canonical_url, revisit, resolved_id, valid, headers for every row of `captures`.

    `captures` has id, url, time (long), status, etag, last_modified and headers (map, names in lower case). Status 304 is a
    revisit. resolved_id is the latest full response (200) of the URL before it in time, then id; a full response is its own. It is valid if each
    validator that both have is equal; else, and without an earlier response, resolved_id is null. A null URL has no
    canonical form and resolves nothing. Headers are the response's with those the revisit may update. A null time counts as
    0. Repeated rows are captures of their own, of one time and id in any order. Other columns of `captures` are not read, so
    their names don't matter; an empty table gives no rows. A busy URL is cut into stretches of `STRETCH` units of time, so
    the unit should be such that a stretch of one URL fits a task: seconds, or the order of the captures.
    """
    rows = captures.select(
        "id", canonical_url(F.col("url")).alias("canonical_url"), F.coalesce("time", F.lit(0)).alias("time"), (F.col("status") == 304).alias("revisit"),
        "etag", "last_modified", "headers", (F.col("status") == 200).alias("full"),
    ).withColumn("stretch", F.floor(F.col("time") / STRETCH))
    response = F.struct("time", F.col("id"), F.col("etag"), F.col("last_modified"), F.col("headers"))
    own = F.when(F.col("full"), response)
    inside = Window.partitionBy("canonical_url", "stretch").orderBy("time", "id").rowsBetween(Window.unboundedPreceding, -1)
    lasts = rows.groupBy("canonical_url", "stretch").agg(F.max_by(own, F.when(F.col("full"), F.struct("time", "id"))).alias("last"))
    across = Window.partitionBy("canonical_url").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    lasts = lasts.select(F.col("canonical_url").alias("u"), F.col("stretch").alias("s"), F.last("last", True).over(across).alias("earlier"))
    found = rows.withColumn("near", F.last(own, True).over(inside))
    found = found.join(lasts, (F.col("canonical_url") == F.col("u")) & (F.col("stretch") == F.col("s")), "left")
    found = found.withColumn("at", F.coalesce("near", "earlier"))
    same = [F.coalesce(F.col(c) == F.col(f"at.{c}"), F.lit(True)) for c in ("etag", "last_modified")]
    valid = F.col("canonical_url").isNotNull() & F.col("at").isNotNull() & same[0] & same[1]
    updates = F.map_filter(F.coalesce("headers", F.create_map().cast("map<string,string>")), lambda k, _: k.isin(*UPDATABLE))
    kept = F.map_filter(F.col("at.headers"), lambda k, _: ~F.array_contains(F.map_keys(updates), k))
    resolved = F.col("revisit") & valid
    return found.select(
        "id", "canonical_url", F.coalesce("revisit", F.lit(False)).alias("revisit"),
        F.when(F.col("full"), F.col("id")).when(resolved, F.col("at.id")).alias("resolved_id"),
        F.coalesce(F.col("full") | resolved, F.lit(False)).alias("valid"),
        F.when(resolved, F.coalesce(F.map_concat(kept, updates), updates)).otherwise(F.col("headers")).alias("headers"),
    )
