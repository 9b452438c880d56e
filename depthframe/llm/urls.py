"""URL filters: pattern rules indexed by their rarest literal token, in DataFrame functions only.

Every rule has a regular expression and the literal tokens that any url it fits must
contain. Token frequencies over the whole table choose each rule's rarest token; the index
maps that token to the rule. The tokens of a url fetch candidate rules by an equi-join and
only those run their expression.

Scale: work is per distinct url. Rules are given by the caller; at most ``MAX_BROADCAST_RULES``
of them are broadcast, more are joined by a shuffle. Rule fitting needs no shuffle beyond the
one that makes urls distinct.

Defined results: a null url, or one without ``://``, has empty host and path, no rule, and the
verdict allow. Repeated rows give repeated results; ties between rules go to the longer text,
then to the smaller one; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MAX_BROADCAST_RULES = 10_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What lies between tokens.
GAP = r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+"


@dataclass(frozen=True)
class Rule:
    """``text`` names the rule; ``literal`` is text whose whole tokens every fitting url contains."""

    text: str
    action: str
    literal: str
    regex: str
    listed: bool = True


def host_rule(action: str, host: str, path: str) -> Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""
    whole = path if path.endswith("/") else path.rpartition("/")[0]
    return Rule(host + path, action, f"{host}/{whole}", rf"^(?:[^/]*\.)?\Q{host + path}\E")


def host_word(action: str, words: str) -> Rule:
    """Fits a host with a label that holds these dash-joined words as whole words."""
    return Rule(words, action, words, rf"^(?:[^/]*[.-])?\Q{words}\E(?:[.:-][^/]*)?(?:/|$)", listed=False)


LISTED = (
    host_rule("block", "net", "/"),
    host_rule("allow", "example.net", "/en/"),
    host_rule("block", "example.com", "/de/"),
    host_rule("allow", "org", "/fr/"),
)
#: The method's own rules, used where no listed rule fits.
PATTERNS = tuple(host_word("block", w) for w in ("casino", "bets", "poker", "cheap-pills", "viagra", "spam", "ads-track", "adult", "porn"))


def with_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds host and path."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return df.withColumns({"host": F.translate(host, UPPER, LOWER), "path": path})


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    rows = [F.struct(F.lit(i).alias("rule_id"), F.lit(r.text).alias("text"), F.lit(r.action).alias("action"), F.lit(r.literal).alias("literal"), F.lit(r.regex).alias("regex"), F.lit(r.listed).alias("listed")) for i, r in enumerate(rules)]
    return spark.range(1).select(F.inline(F.array(*rows)))


def tokens(text) -> F.Column:
    return F.array_distinct(F.filter(F.split(text, GAP), lambda t: t != ""))


def filter_urls(pages: DataFrame, rules: Sequence[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` plus host, path, rule, pattern and verdict."""
    spark = pages.sparkSession
    small = (lambda df: F.broadcast(df)) if len(rules) <= MAX_BROADCAST_RULES else (lambda df: df)
    urls = with_parts(pages.select(F.col(url).alias("url")).filter(F.col("url").isNotNull()).distinct())
    urls = urls.withColumn("subject", F.concat("host", "path"))
    found = urls.select("url", "subject", F.explode(tokens("subject")).alias("token"))
    table = rule_table(spark, rules)
    literals = table.select("rule_id", F.explode(tokens("literal")).alias("token"))
    frequency = found.join(small(literals.select("token").distinct()), "token").groupBy("token").agg(F.count("*").alias("n"))
    rarest = Window.partitionBy("rule_id").orderBy(F.coalesce("n", F.lit(0)), "token")
    index = literals.join(frequency, "token", "left").withColumn("place", F.row_number().over(rarest)).filter("place = 1").join(table, "rule_id")
    fitting = found.join(small(index.select("token", "text", "action", "regex", "listed")), "token").filter(F.expr("subject rlike regex"))
    # max by (length, text reversed in order) is the longest rule, ties to the smaller text
    order = F.struct(F.length("text").alias("size"), "text", "action")
    best = fitting.groupBy("url").agg(F.max(F.when(F.col("listed"), order)).alias("of_list"), F.max(F.when(~F.col("listed"), order)).alias("of_method"))
    judged = with_parts(pages.withColumnRenamed(url, "url") if url != "url" else pages).join(best, "url", "left")
    judged = judged.withColumns({
        "rule": F.col("of_list.text"),
        "pattern": F.col("of_method.text"),
        "verdict": F.coalesce("of_list.action", "of_method.action", F.lit(default)),
    }).drop("of_list", "of_method")
    return judged.withColumnRenamed("url", url) if url != "url" else judged


def op4_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return filter_urls(pages, LISTED + PATTERNS).select("page_id", "host", "path", "rule", "verdict", "pattern")


OP4_SQL = r"""
WITH r AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM (SELECT page_id, coalesce(rest, '') AS rest FROM r)),
l AS (SELECT * FROM (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) AS t(h, q, action)),
w AS (SELECT * FROM (VALUES ('casino'), ('bets'), ('poker'), ('cheap-pills'), ('viagra'), ('spam'), ('ads-track'), ('adult'), ('porn')) AS t(word)),
a AS (
  SELECT p.page_id, p.host, p.path,
    (SELECT max(struct_pack(n := length(h || q), t := h || q, a := action)) FROM l WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q)) AS best,
    (SELECT max(struct_pack(n := length(word), t := word)) FROM w WHERE regexp_matches(host || path, '^([^/]*[.-])?' || word || '([.:-][^/]*)?(/|$)')) AS own
  FROM p)
SELECT page_id, host, path, best.t AS rule, coalesce(best.a, CASE WHEN own IS NOT NULL THEN 'block' END, 'allow') AS verdict, own.t AS pattern FROM a
"""
