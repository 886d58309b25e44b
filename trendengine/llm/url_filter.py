"""URL rules by host suffix and path prefix, through hashed expressions, with Spark expressions only.

A rule (host, path, verdict) fits a URL if its host is the rule's or a subdomain of it, and its path starts with the rule's.
Each URL is expanded into host-suffix and path-prefix expressions, of the shapes (labels, path length) that
rules have. Expressions and rules meet on the first `SHORT` hex digits of a SHA-256; the full digest then decides. Of the
rules that fit, the longest (host and path together) wins; then the longer host, then block before allow.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: from there up to ``?`` or ``#``. A null url,
or one without ``://``, has both empty and fits no rule that has a host.

Scale: URLs are reduced to distinct (host, path) before they are expanded, so a URL that fills a third of the table is judged once;
rules go into a broadcast only where Spark finds their size below its threshold, else the join is a shuffle with skew
handling. Only the shapes of rules reach the driver: pairs of small numbers, no more than labels times
path lengths. Rules with a null host or path never fit; repeated rules are one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendengine.llm.common import any_columns, fresh, table

SHORT = 8
DEFAULT = "allow"
RULES_DDL = "rule_host string, rule_path string, verdict string"
#: The rules of the registered query.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)


def _labels(host):
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


@any_columns("url")
def judge(spark: SparkSession, pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """``pages`` and host, path, rule (or null), verdict; a clashing column of ``pages`` keeps its name, the new one grows."""
    rules = rules.dropna(subset=["rule_host", "rule_path"]).select(
        F.concat("rule_host", "rule_path").alias("rule"),
        F.length("rule_host").alias("host_length"),
        F.coalesce(F.col("verdict") == "block", F.lit(False)).alias("blocks"),
        "verdict",
        _labels(F.col("rule_host")).alias("labels"),
        F.length("rule_path").alias("path_length"),
        F.sha2(F.concat("rule_host", "rule_path"), 256).alias("digest"),
    )
    shapes = [tuple(r) for r in rules.select("labels", "path_length").distinct().collect()]
    names = {c: fresh(c, pages) for c in ("host", "path", "rule", "verdict")}
    host, path = host_and_path(F.col("url"))
    parsed = pages.withColumns({names["host"]: F.coalesce(host, F.lit("")), names["path"]: F.coalesce(path, F.lit(""))})
    urls = parsed.select(F.col(names["host"]).alias("_host"), F.col(names["path"]).alias("_path")).distinct()
    expression = [
        F.when(
            (_labels(F.col("_host")) >= k) & (F.length("_path") >= n),
            F.sha2(F.concat(F.substring_index("_host", ".", -k), F.substring("_path", 1, n)), 256),
        )
        for k, n in sorted(shapes)
    ]
    expanded = urls.select("_host", "_path", F.explode(F.array_compact(F.array(*expression)) if shapes else F.array().cast("array<string>")).alias("_full"))
    short = lambda c: F.substring(c, 1, SHORT)
    met = expanded.withColumn("_short", short("_full")).join(rules.withColumn("_short", short("digest")), "_short")
    rank = F.struct(F.length("rule").alias("n"), "host_length", "blocks", "rule", "verdict")
    best = met.where("_full = digest").groupBy("_host", "_path").agg(F.max(rank).alias("_best"))
    ours = {c: fresh(c, parsed) for c in ("_host", "_path", "_best")}
    best = best.withColumnsRenamed(ours)
    same = (F.col(names["host"]) == F.col(ours["_host"])) & (F.col(names["path"]) == F.col(ours["_path"]))
    verdict = F.coalesce(F.col(f"{ours['_best']}.verdict"), F.lit(default))
    return parsed.join(best, same, "left").select(
        *parsed.columns, F.col(f"{ours['_best']}.rule").alias(names["rule"]), verdict.alias(names["verdict"])
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS t(rule_host, rule_path, verdict)")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(spark, pages, rules).drop("url")


_VALUES = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in RULES)
SQL = rf"""
WITH rules(h, p, v) AS (VALUES {_VALUES}),
a AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM a),
c AS (SELECT row_number() OVER () AS k, page_id, translate(raw, '{UPPER}', '{LOWER}') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM b),
m AS (SELECT k, h || p AS rule, v, row_number() OVER (PARTITION BY k ORDER BY length(h || p) DESC, length(h) DESC, v DESC) AS n
      FROM c JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(v, '{DEFAULT}') AS verdict FROM c LEFT JOIN (SELECT * FROM m WHERE n = 1) USING (k)
"""
