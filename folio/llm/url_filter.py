"""URL filters (operator 8).

Method: each URL is expanded into host-suffix x path-prefix expressions; an
expression's SHA-256 is cut to a short prefix, on which URLs and rules are
equi-joined; a match counts only if the full digest is equal and the URL's path
starts with the rule's whole path.  The longest rule wins; between rules of
equal length the longer host, then block.

A rule's path is hashed up to its last '/' so that expressions end at '/', and
the rest of the path is compared after the join; rules of any path work.
Expressions deeper than the deepest rule are not made: they fit no rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import table

# The rule set of the query.
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
PREFIX_HEX = 8  # 4 bytes of the digest are joined on
BROADCAST_RULES = 100_000  # a larger rule table is joined by shuffle
SALTS = 16  # parts of a rule in that shuffle: one host may hold a third of all URLs


def host_of(url: Column) -> Column:
    after = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))
    return F.translate(F.coalesce(after, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    after = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1))
    return F.coalesce(after, F.lit(""))


def _digest(host: Column, anchor: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), anchor), 256)


def rule_index(rules: DataFrame) -> DataFrame:
    """rule_host, rule_path, action -> the digest of host and path anchor, its prefix and the precedence columns."""
    anchor = F.regexp_extract("rule_path", r"(?s)^(.*/)?", 1)
    return rules.select(
        "rule_host",
        "rule_path",
        "action",
        _digest(F.col("rule_host"), anchor).alias("rule_digest"),
        F.size(F.split("rule_host", r"\.")).alias("labels"),
        F.size(F.split(anchor, "/")).alias("depth"),
    ).withColumn("prefix", F.substring("rule_digest", 1, PREFIX_HEX))


def judge_urls(urls: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict for each row of ``urls`` (page_id, url).

    A null url or one without '://' has an empty host and path, which no rule
    fits (verdict: ``default``).  An empty rule table gives ``default``
    everywhere.  Repeated rows and null page_ids give one row each."""
    index = rule_index(rules)
    n, labels, depth = index.agg(F.count("*"), F.coalesce(F.max("labels"), F.lit(0)), F.coalesce(F.max("depth"), F.lit(0))).first()
    u = urls.select(F.monotonically_increasing_id().alias("_row"), "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    parts = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(labels, 1)))),
        lambda k: F.array_join(F.slice(parts, -k, k), "."),
    )
    steps = F.split("path", "/")
    # anchors: '' and every prefix of the path that ends in '/', down to the deepest rule's
    anchors = F.transform(
        F.sequence(F.lit(1), F.least(F.size(steps), F.lit(max(depth, 1)))),
        lambda k: F.when(k == 1, F.lit("")).otherwise(F.concat(F.array_join(F.slice(steps, 1, k - 1), "/"), F.lit("/"))),
    )
    # at least one expression a row, so that the left join below keeps every row
    expressions = (
        u.withColumn("_host", F.explode(suffixes))
        .withColumn("_anchor", F.explode(anchors))
        .withColumn("_digest", _digest(F.col("_host"), F.col("_anchor")))
        .select("_row", "page_id", "host", "path", "_digest", F.substring("_digest", 1, PREFIX_HEX).alias("prefix"))
    )
    if n <= BROADCAST_RULES:
        joined = expressions.join(F.broadcast(index), "prefix", "left")
    else:
        salted = index.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = expressions.withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(SALTS)).cast("int")).join(salted, ["prefix", "_salt"], "left")
    fits = (F.col("_digest") == F.col("rule_digest")) & F.expr("startswith(path, rule_path)")
    precedence = F.struct(
        F.length(F.concat("rule_host", "rule_path")).alias("n"),
        F.length("rule_host").alias("h"),
        (F.col("action") == "block").cast("int").alias("b"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.col("action").alias("action"),
    )
    return (
        joined.groupBy("_row", "page_id", "host", "path")
        .agg(F.max(F.when(fits, precedence)).alias("_best"))
        .select("page_id", "host", "path", F.col("_best.rule").alias("rule"), F.coalesce("_best.action", F.lit(default)).alias("verdict"))
    )


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "rule_host string, rule_path string, action string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


def oracle(rules: list[tuple[str, str, str]] = RULES) -> str:
    values = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in rules)
    return f"""
WITH rules(rh, rp, action) AS (VALUES {values}),
cut AS (
  SELECT row_number() OVER () AS r, page_id,
         CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
u AS (
  SELECT r, page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
hit AS (
  SELECT r, rh || rp AS rule, action,
         row_number() OVER (PARTITION BY r ORDER BY length(rh || rp) DESC, length(rh) DESC, action = 'block' DESC) AS k
  FROM u JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM u LEFT JOIN (SELECT * FROM hit WHERE k = 1) USING (r)"""
