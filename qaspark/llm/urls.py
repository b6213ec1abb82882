"""URL filters: pattern rules looked up by their rarest literal token.

A rule has an action, a regular expression over the address and the literal
tokens that every matching address must hold (runs of letters and digits).
Tokens are counted over all addresses; each rule is indexed by the token
that the fewest addresses hold. The tokens of an address fetch the rules
indexed under them by a join, and only those rules run their expression.
Rules without a literal token apply to every address and are checked apart.

Defined cases: a null address, or one without ``://``, has an empty host and
path and matches no rule; the longest matching rule wins, host rules come
before the method's own; repeated rows and equal addresses get equal rows;
extra columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qaspark.llm.common import materialise

# Fixed values of the contract: action and rule (host, path).
HOST_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
# Own pattern rules for addresses without a host rule: action, expression
# over host and path, literal tokens that a match must hold as whole tokens.
PATTERN_RULES = (
    ("block", r"^[^/]*\bspam\b", ("spam",)),
    ("block", r"^[^/]*\bcheap-pills\b", ("cheap", "pills")),
    ("block", r"^[^/]*\badult\b", ("adult",)),
    ("block", r"^[^/]*\bads-track\b", ("ads", "track")),
    ("block", r"^[^/]*\bcasino\b", ("casino",)),
    ("block", r"^[^/]*\bfree-bets\b", ("free", "bets")),
    ("block", r"/wp-login\.php$", ("wp", "login", "php")),
)


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty if there is none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty if there's none."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def compile_host_rule(action: str, rule: str) -> tuple:
    """``action, rule, rank, pattern, tokens`` of a host and path rule: it
    fits its host and all subdomains, and paths that start with its path."""
    name, _, start = rule.partition("/")
    pattern = rf"(?s)^([^/]*\.)?{re.escape(name)}/{re.escape(start)}"
    return action, rule, 1_000_000 + len(rule), pattern, re.findall(r"[a-z0-9]+", name)


def compile_rules(host_rules=HOST_RULES, pattern_rules=PATTERN_RULES) -> list[tuple]:
    own = [(action, None, len(p), p, list(tokens)) for action, p, tokens in pattern_rules]
    return [compile_host_rule(*r) for r in host_rules] + own


def _tokens(address: Column) -> Column:
    return F.array_distinct(F.array_remove(F.split(F.lower(address), "[^a-z0-9]+"), F.lit("")))


def rule_table(spark: SparkSession, rules: list[tuple]) -> DataFrame:
    rows = [(i, *r) for i, r in enumerate(rules)]
    return spark.createDataFrame(rows, "rule_id long, action string, rule string, rank long, pattern string, tokens array<string>")


def indexed_rules(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """``rules`` with ``token``: their literal token that the fewest
    addresses hold, counted over ``tokens`` (one row per address and token);
    ties to the smaller token, null for rules without one."""
    wanted = rules.select("rule_id", F.explode("tokens").alias("token"))
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = (
        wanted.join(counts, "token", "left")
        .groupBy("rule_id")
        .agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token"))
    )
    return rules.drop("tokens").join(rarest, "rule_id", "left")


def filter_urls(pages: DataFrame, rules: list[tuple] | None = None, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, rule_kind`` for every row."""
    spark = pages.sparkSession
    pages = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    split = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    split = split.withColumn("address", F.when(F.col("host") != "", F.concat("host", "path")))
    known = materialise(split.where("address is not null").select("address").distinct(), "addresses")
    held = known.select("address", F.explode(_tokens(F.col("address"))).alias("token"))
    table = materialise(indexed_rules(rule_table(spark, rules or compile_rules()), held), "rules")
    fetched = held.join(table.where("token is not null"), "token").select("address", "action", "rule", "rank", "pattern")
    always = [(r["action"], r["rule"], r["rank"], r["pattern"]) for r in table.where("token is null").toLocalIterator()]
    if always:  # as many as the rule list holds, never as the addresses
        literal = F.array(*[F.struct(*[F.lit(x).alias(k) for k, x in zip(("action", "rule", "rank", "pattern"), r, strict=True)]) for r in always])
        fetched = fetched.unionByName(known.select("address", F.inline(literal)))
    matched = fetched.where(F.expr("address rlike pattern"))
    best = matched.groupBy("address").agg(F.max_by(F.struct("action", "rule"), F.struct("rank", "pattern")).alias("best"))
    joined = split.join(best, "address", "left")
    return joined.select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.action", F.lit("allow")).alias("verdict"),
        F.when(F.col("best").isNull(), "none").when(F.col("best.rule").isNull(), "pattern").otherwise("host").alias("rule_kind"),
    )


URLS_SQL = r"""
WITH p AS (SELECT page_id, coalesce(url, '') AS u FROM pages),
s AS (SELECT page_id, translate(regexp_extract(u, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(u, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM p),
r AS (SELECT *, CASE WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule FROM s)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(host, '\b(spam|cheap-pills|adult|ads-track|casino|free-bets)\b') OR (host <> '' AND regexp_matches(path, '/wp-login\.php$')) THEN 'block'
    ELSE 'allow' END AS verdict,
    CASE WHEN rule IS NOT NULL THEN 'host' WHEN regexp_matches(host, '\b(spam|cheap-pills|adult|ads-track|casino|free-bets)\b')
    OR (host <> '' AND regexp_matches(path, '/wp-login\.php$')) THEN 'pattern' ELSE 'none' END AS rule_kind FROM r
"""
