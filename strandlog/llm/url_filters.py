"""URL filters: host-suffix and path-prefix expressions looked up by short hash, confirmed by digest.

Each URL is expanded into (host suffix + path prefix) expressions, but only for the label counts and
path lengths that some rule has, so a URL makes no more rows than there are distinct rule shapes.
Expressions meet rules in an equi-join on the first four bytes of SHA-256; the full digest is compared
after. The longest rule wins; among equal lengths the longer host does, then block before allow. One
aggregate over the matches returns the verdicts.

Defined cases: a null URL or one without ``://`` has an empty host and path and no rule; a URL is judged
by its own text, so repeated rows and ids each get a row; with no rules, or no match, the verdict is
``default``; URLs of any length are judged whole; an empty table gives an empty result; other columns of the
input are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlog.llm import common

#: action, host, path
RULES: tuple[tuple[str, str, str], ...] = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)
DEFAULT = "allow"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Rules as a table of action, host and path, the form in which a large list would be read."""
    return spark.createDataFrame(list(rules), "action string, host string, path string")


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: page_id, host, path, rule (host + path, or null) and verdict."""
    digest = F.sha2(F.concat_ws("\u0000", F.col("host"), F.col("path")), 256)
    keyed = (
        rules.where(F.col("action").isin("allow", "block") & F.col("host").isNotNull() & F.col("path").isNotNull())
        .select(F.translate("host", _UPPER, _LOWER).alias("host"), "path", "action")
        .groupBy("host", "path")
        .agg(F.max("action").alias("action"))  # of two rules for one place, block holds
        .select(F.col("host").alias("r_host"), F.col("path").alias("r_path"), "action", digest.alias("r_digest"))
        .withColumn("short", F.substring("r_digest", 1, 8))
    )
    shapes = keyed.select(F.size(F.split("r_host", r"\.")).alias("labels"), F.length("r_path").alias("chars")).distinct()
    # Shapes are pairs of small numbers: as many as rule lengths, whatever the number of rules.
    found = [(r["labels"], r["chars"]) for r in shapes.limit(common.BROADCAST_ROWS + 1).collect()]
    if len(found) > common.BROADCAST_ROWS:
        raise ValueError("more shapes of rules than a list can hold")
    few = keyed.limit(common.BROADCAST_ROWS + 1).count() <= common.BROADCAST_ROWS

    parts = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("u"))
    parts = parts.select("page_id", "u", host_of(F.col("u")).alias("host"), path_of(F.col("u")).alias("path"))
    if not found:
        return parts.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))

    # The same place is looked up once, however many pages have it.
    places = parts.where(F.col("u").contains("://")).select("host", "path").distinct()
    # One expression over a constant list of shapes, not one a shape.
    labels = F.size(F.split("host", r"\."))
    every = F.from_json(F.lit(json.dumps([{"n": n, "c": c} for n, c in sorted(found)])), "array<struct<n:int,c:int>>")
    fits = F.filter(every, lambda s: (labels >= s["n"]) & (F.length("path") >= s["c"]))
    tries = F.transform(fits, lambda s: F.struct(F.call_function("substring_index", F.col("host"), F.lit("."), -s["n"]).alias("host"), F.col("path").substr(F.lit(1), s["c"]).alias("path")))
    expanded = places.select("host", "path", F.explode(tries).alias("e"))
    expanded = expanded.select("host", "path", F.sha2(F.concat_ws("\u0000", F.col("e.host"), F.col("e.path")), 256).alias("digest"))
    expanded = expanded.withColumn("short", F.substring("digest", 1, 8))
    hits = expanded.join(F.broadcast(keyed) if few else keyed, "short").where(F.col("digest") == F.col("r_digest"))
    best = F.struct(
        (F.length("r_host") + F.length("r_path")).alias("size"),
        F.length("r_host").alias("host_size"),
        F.col("action").alias("action"),  # 'block' sorts above 'allow'
        F.concat("r_host", "r_path").alias("rule"),
    )
    won = hits.groupBy("host", "path").agg(F.max(best).alias("best"))
    return parts.join(won, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce(F.col("best.action"), F.lit(default)).alias("verdict")
    )


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(common.read(spark, sf_dir, "pages"), rule_table(spark))


_CASES = reduce(lambda a, r: [*a, f"('{r[0]}', '{r[1]}', '{r[2]}')"], RULES, [])
ORACLE_SQL = rf"""
WITH r(action, rhost, rpath) AS (VALUES {", ".join(_CASES)}),
p AS (SELECT row_number() OVER () AS rid, page_id,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
m AS (SELECT rid, rhost || rpath AS rule, action,
        row_number() OVER (PARTITION BY rid ORDER BY length(rhost || rpath) DESC, length(rhost) DESC, action DESC) AS k
      FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM p LEFT JOIN (SELECT * FROM m WHERE k = 1) USING (rid)
"""
