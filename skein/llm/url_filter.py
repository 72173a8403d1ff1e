"""URL filtering by host-suffix and path-prefix expressions and hash prefixes.

Every URL is expanded into expressions ``host suffix + path prefix``; the
SHA-256 of an expression is cut to a short prefix, an equi-join on that prefix
finds candidate rules, and the full digest confirms them. Of the confirmed rules
the longest wins (most characters, then the longest host; block before allow).

A rule is (host, path, verdict). It fits its host and all subdomains, when the
URL's path starts with the rule's path. Only expressions that a rule can have
are made: suffixes of as many labels, and prefixes of as many characters, as some
rule has. DataFrame functions only; there is no Python on the data's path.

A verdict depends on the URL alone, so different URLs are judged once and the
verdicts of those that some rule fits are written and joined back; the join is
between two plain tables, which lets Spark broadcast the verdicts when they are
small and split a URL that a large share of the pages has when they are not.

Defined results: a null URL or one without ``://`` has an empty host and path
and no rule; without a rule the verdict is ``default``; null page ids and
repeated rows are kept as they are; an empty rule table leaves every URL to the
default; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.common import materialize, pick, read_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX_HEX = 8      # characters of the digest that are joined on: 32 bits

RULES = [           # (host, path, verdict): fixed values of the registered query
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) after the first ``://`` and the path after it,
    both empty where there is none."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def _key(expression: Column) -> tuple[Column, Column]:
    digest = F.sha2(expression, 256)
    return F.substring(digest, 1, PREFIX_HEX), digest


def url_verdicts(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` has one column ``url``; returns url, rule, verdict for every
    different URL that a rule fits."""
    shaped = (rules.where("host IS NOT NULL AND host != '' AND path IS NOT NULL")
              .select(F.translate("host", UPPER, LOWER).alias("r_host"),
                      F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict")))
    # the shapes rules have: label counts and path lengths, each a small set
    shapes = shaped.agg(F.collect_set(_labels(F.col("r_host"))).alias("labels"),
                        F.collect_set(F.length("r_path")).alias("lengths")).first()
    host, path = host_and_path(F.col("url"))
    parts = urls.select("url").distinct().select("url", host.alias("host"), path.alias("path"))
    no = F.lit(None).cast("string")
    suffixes = F.array(*[
        F.when(_labels(F.col("host")) >= k, F.substring_index("host", ".", -k)).otherwise(no)
        for k in sorted(shapes["labels"])] or [no])
    prefixes = F.array(*[
        F.when(F.length("path") >= n, F.substring("path", 1, n)).otherwise(no)
        for n in sorted(shapes["lengths"])] or [no])
    expanded = (parts.where("host != ''")
                .select("url", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
                .where("suffix IS NOT NULL")
                .select("url", "suffix", F.explode("prefixes").alias("prefix"))
                .where("prefix IS NOT NULL"))
    short, digest = _key(F.concat("suffix", "prefix"))
    expanded = expanded.select("url", short.alias("short"), digest.alias("digest"))
    short, digest = _key(F.concat("r_host", "r_path"))
    keyed = shaped.select(
        short.alias("short"), digest.alias("r_digest"),
        F.struct((F.length("r_host") + F.length("r_path")).alias("size"),
                 F.length("r_host").alias("host_size"),
                 (F.col("r_verdict") == "block").alias("block"),
                 F.concat("r_host", "r_path").alias("rule"),
                 F.col("r_verdict").alias("verdict")).alias("found"))
    return (expanded.join(keyed, "short").where("digest = r_digest")
            .groupBy("url").agg(F.max("found").alias("found"))
            .select("url", "found.rule", "found.verdict"))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """One row per page: page_id, host, path, rule (null if none fits), verdict."""
    rows = pick(pages, page_id=id_col, url=url_col)
    verdicts = materialize(url_verdicts(rows, rules), "url-verdicts").select(
        F.col("url").alias("v_url"), "rule", F.col("verdict").alias("v_verdict"))
    host, path = host_and_path(F.col("url"))
    return (rows.join(verdicts, F.col("url") == F.col("v_url"), "left")
            .select("page_id", host.alias("host"), path.alias("path"), "rule",
                    F.coalesce("v_verdict", F.lit(default)).alias("verdict")))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the fixed rules."""
    return judge_urls(read_table(spark, sf_dir, "pages"), rule_table(spark, RULES))


OP3_SQL = """
WITH parts AS (
  SELECT page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
named AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*', 0),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts)
SELECT page_id, host, path,
       CASE WHEN r = 1 THEN 'example.org/en/1' WHEN r = 2 THEN 'example.org/es/'
            WHEN r = 3 THEN 'org/' WHEN r = 4 THEN 'com/fr/' WHEN r = 5 THEN 'com/de/' END AS rule,
       CASE WHEN r IN (1, 2, 5) THEN 'block' ELSE 'allow' END AS verdict
FROM (
  SELECT page_id, host, path,
         CASE WHEN (host = 'example.org' OR ends_with(host, '.example.org'))
                   AND starts_with(path, '/en/1') THEN 1
              WHEN (host = 'example.org' OR ends_with(host, '.example.org'))
                   AND starts_with(path, '/es/') THEN 2
              WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 3
              WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 4
              WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 5
         END AS r
  FROM named)
"""
