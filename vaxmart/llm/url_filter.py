"""URL filter: regular-expression rules indexed by their rarest literal token.

A rule is a regular expression over ``host + path`` together with the literal tokens that every URL it matches holds
whole (runs of letters and digits between delimiters).  Token frequencies are counted over all URLs, a rule is filed
under its rarest token, a URL's tokens fetch the rules filed under them, and only those expressions run.  Rules
without a literal token are tried on every URL.  The longest rule that matches wins (ties: the rule that sorts first);
without one the method's own verdict is ``allow``.

Cases: a null URL, or one without ``://``, has empty host and path, no tokens and no rule.  Repeated URLs get repeated
results.  Columns other than the id and the URL are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaxmart.llm.common import prepare

#: Fixed rules of the production filter: verdict, host, path.
HOST_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Rule tables up to this many rows are sent to every executor; larger ones are joined by a shuffle.
BROADCAST_RULES = 200_000
DEFAULT_VERDICT = "allow"
_TOKEN = "[^a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    rule: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """A rule for a host, all its subdomains and a path prefix.  A path's last token counts as literal only if a
    delimiter follows it, since a URL may continue an unfinished one."""
    pattern = rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}"
    kept = path if not path or re.fullmatch(r"[^a-z0-9]", path[-1].lower()) else re.sub(r"[A-Za-z0-9]+$", "", path)
    tokens = re.split(_TOKEN, f"{host}/{kept}".lower())
    return Rule(f"{host}{path}", verdict, pattern, tuple(dict.fromkeys(t for t in tokens if t.isascii() and t)))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^?#]*", 0)
    host = F.regexp_extract(rest, r"^[^/]*", 0)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), F.regexp_extract(rest, r"^[^/]*(/[\s\S]*)?$", 1)


def tokens(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(text), _TOKEN), lambda t: t != ""))


def judge(pages: DataFrame, rules: list[Rule], page_id: str = "page_id", url: str = "url") -> DataFrame:
    """One row per input row: id, host, path, rule, verdict and the number of expressions tried (``n_tried``)."""
    spark = pages.sparkSession
    prepare(spark)
    host, path = split_url(F.col(url).cast("string"))
    # Rules see a URL only through host and path: equal ones are judged once, which also gathers a hot host's rows.
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    keys = rows.where(F.col("host") != "").groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"))
    table = spark.createDataFrame(
        [(r.rule, r.verdict, r.pattern, list(r.tokens)) for r in rules],
        "rule string, verdict string, pattern string, tokens array<string>")
    bounded = len(rules) <= BROADCAST_RULES
    send = F.broadcast if bounded else (lambda df: df)

    literal = table.select("rule", F.explode("tokens").alias("token"))
    counts = (
        keys.select("n", F.explode(tokens(F.concat("host", "path"))).alias("token"))
        .join(send(literal.select("token").distinct()), "token", "left_semi")
        .groupBy("token").agg(F.sum("n").alias("n"))
    )
    rarest = (
        literal.join(send(counts), "token", "left")
        .groupBy("rule").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))["token"].alias("token"))
    )
    index = table.drop("tokens").join(rarest, "rule", "left")
    filed, unfiled = index.where("token IS NOT NULL"), index.where("token IS NULL")

    exploded = keys.select("host", "path", F.explode(tokens(F.concat("host", "path"))).alias("token"))
    fetched = exploded.join(send(filed), "token").select("host", "path", "rule", "verdict", "pattern")
    if any(not r.tokens for r in rules):
        every = F.array(*[F.struct(F.lit(r.rule).alias("rule"), F.lit(r.verdict).alias("verdict"),
                                   F.lit(r.pattern).alias("pattern")) for r in rules if not r.tokens])
        fetched = fetched.unionByName(keys.select("host", "path", F.inline(every)))
    matched = F.expr("rlike(concat(host, path), pattern)")
    best = (
        fetched.groupBy("host", "path").agg(
            F.count(F.lit(1)).alias("n_tried"),
            F.min(F.when(matched, F.struct((-F.length("rule")).alias("len"), "rule", "verdict"))).alias("best"))
    )
    return (
        rows.join(best, ["host", "path"], "left")
        .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                F.coalesce("best.verdict", F.lit(DEFAULT_VERDICT)).alias("verdict"),
                F.coalesce("n_tried", F.lit(0)).cast("long").alias("n_tried"))
    )


RULES = [host_rule(*r) for r in HOST_RULES]

ORACLE = """
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         CASE WHEN instr(rest, '/') > 0 THEN substr(rest, instr(rest, '/')) ELSE '' END AS path
  FROM cut
), judged AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
  END AS rule
  FROM parts
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""
