"""URL filters: pattern rules indexed by their rarest literal token; a URL's tokens fetch the rules that may match."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import UPPER, table

# Rules that one pass carries to the executors; a longer list is applied in several passes over the same rows.
RULES_PER_PASS = 50_000
TOKEN = re.compile(r"[a-z0-9]+")
# Rules of the first tier, fixed values of the contract.
HOST_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
# Patterns of the second tier. `*` is any text, `^` any separator or the end, `||` the start of a host label.
PATTERNS = [
    ("^utm_source=feed^", "block"), ("^doubleclick^", "block"), ("/wp-login.php", "block"), ("/cart/checkout^", "block"),
    ("^sessionid=*", "block"), ("^affiliate=*", "block"), ("||ads.", "block"), ("||tracker.", "block"),
    ("/robots.txt^", "block"), ("^sponsored=true^", "allow"),
]


class Rule(NamedTuple):
    """A rule: its text, verdict, tier (hosts before patterns), regular expression and usable literal tokens."""

    text: str
    verdict: str
    tier: int
    regex: str
    tokens: tuple[str, ...]


def host_rule(text: str, verdict: str) -> Rule:
    """``host/path``: fits the host and its subdomains if the path starts with the rule's; matched on host + path."""
    regex = rf"\A(?:[^/]*\.)?{re.escape(text)}"
    # The last token of a path that may go on is no whole token of every URL that fits.
    return Rule(text, verdict, 1, regex, _whole(text, True, text[-1:].isascii() and not text[-1:].isalnum()))


def pattern_rule(text: str, verdict: str) -> Rule:
    """A pattern with wildcards, matched anywhere in the lower-cased URL."""
    body, start = (text[2:], r"\A[^/?#]*://(?:[^/?#]*[./@])??") if text.startswith("||") else (text, "")
    parts = {"*": "(?s:.*)", "^": r"(?:[^a-z0-9_.%-]|\Z)"}
    regex = start + "".join(parts.get(x) or re.escape(x) for x in body.lower())
    return Rule(text, verdict, 2, regex, _whole(body.lower(), bool(start), False))


def _whole(text: str, left: bool, right: bool) -> tuple[str, ...]:
    """Alphanumeric runs that must stand as whole tokens in any text that fits: no wildcard or open end beside them."""
    found = []
    for m in TOKEN.finditer(text):
        before, after = text[:m.start()][-1:], text[m.end():][:1]
        if (before != "*" if before else left) and (after != "*" if after else right):
            found.append(m.group())
    return tuple(dict.fromkeys(found))


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    shape = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, shape, i), F.lit("")) for i in (1, 2))
    return F.translate(host, UPPER, UPPER.lower()), path


def token_counts(df: DataFrame, url: str, wanted: set[str]) -> dict[str, int]:
    """How many rows hold each token of the rules; the answer is no longer than the rules."""
    tokens = F.array_distinct(F.split(F.translate(url, UPPER, UPPER.lower()), "[^a-z0-9]+"))
    spark = df.sparkSession
    if not wanted:
        return {}
    names = spark.createDataFrame([(x,) for x in sorted(wanted)], "token string")
    # As long as the rules that one pass may carry; more tokens than that are joined by shuffle.
    names = F.broadcast(names) if len(wanted) <= 4 * RULES_PER_PASS else names
    counts = df.select(F.explode(tokens).alias("token")).join(names, "token").groupBy("token").count()
    return {r.token: r["count"] for r in counts.collect()}


def build_index(rules: list[Rule], counts: dict[str, int]) -> tuple[dict[str, list[int]], list[int]]:
    """Token to rules, each rule under its rarest token; and the rules without one, which run on every URL."""
    index, always = defaultdict(list), []
    for i, rule in enumerate(rules):
        if rule.tokens:
            index[min(rule.tokens, key=lambda t: (counts.get(t, 0), t))].append(i)
        else:
            always.append(i)
    return dict(index), always


def _matcher(rules: list[Rule], index: dict[str, list[int]], always: list[int]):
    def best(url: str | None, where: str, seen: dict) -> tuple[str | None, str | None, int]:
        lower = (url or "").translate(_LOWER)
        found, rank = None, (9, 0, "")
        for i in sorted({*always, *(i for t in set(TOKEN.findall(f"{lower} {where}")) for i in index.get(t, ()))}):
            rule = rules[i]
            mine = (rule.tier, -len(rule.text), rule.text)
            if mine < rank and seen.setdefault(i, re.compile(rule.regex)).search(where if rule.tier == 1 else lower):
                found, rank = rule, mine
        return (found.text, found.verdict, found.tier) if found else (None, None, 9)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict = {}
        for batch in batches:
            found = [best(u, h + p, seen) for u, h, p in zip(batch["url"], batch["host"], batch["path"])]
            old = list(zip(batch["rule_text"], batch["rule_verdict"], batch["tier"]))
            order = lambda x: (x[2], -len(x[0] or ""), x[0] or "")
            found = [min(a, b, key=order) for a, b in zip(found, old)]
            yield batch.assign(rule_text=[x[0] for x in found], rule_verdict=[x[1] for x in found],
                               tier=[x[2] for x in found])
    return run


_LOWER = str.maketrans(UPPER, UPPER.lower())


def judge_urls(df: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url", default: str = "allow",
               per_pass: int = RULES_PER_PASS) -> DataFrame:
    """Judge every URL: key, url, host, path, rule_text, rule_verdict, tier (1 host, 2 pattern, 9 none), verdict.

    One grouped aggregation counts how often the rules' literal tokens occur in the URLs; each rule is filed under its
    rarest. Rows then pass through once, without a shuffle: a URL's tokens fetch candidates from the index and only
    those run their regular expressions. Host rules come before patterns; within a tier the longest rule wins, then the
    smaller text. Rules without a whole literal token run on every URL. A rule list longer than ``per_pass`` is applied
    in several passes, so that what is sent to the executors stays bounded.

    A null or malformed URL has empty host and path and gets the default, unless a pattern fits. An empty table gives an
    empty result; repeated rows are judged each; other columns are ignored.
    """
    host, path = url_parts(F.col(url))
    rows = df.select(F.col(key).alias("key"), F.col(url).alias("url"), host.alias("host"), path.alias("path"),
                     F.lit(None).cast("string").alias("rule_text"), F.lit(None).cast("string").alias("rule_verdict"),
                     F.lit(9).alias("tier"))
    counts = token_counts(df, url, {t for r in rules for t in r.tokens})
    for at in range(0, len(rules), per_pass):
        part = rules[at:at + per_pass]
        rows = rows.mapInPandas(_matcher(part, *build_index(part, counts)), rows.schema)
    return rows.withColumn("verdict", F.coalesce("rule_verdict", F.lit(default))).withColumnRenamed("key", key)


def all_rules() -> list[Rule]:
    return [host_rule(*x) for x in HOST_RULES] + [pattern_rule(*x) for x in PATTERNS]


def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict of every page's URL."""
    judged = judge_urls(table(spark, folder, "pages"), all_rules())
    first = F.when(F.col("tier") == 1, F.col("rule_text"))
    pattern = F.when(F.col("tier") == 2, F.col("rule_text"))
    return judged.select("page_id", "host", "path", first.alias("rule"), "verdict", pattern.alias("pattern"))


OP2_SQL = r"""
with p as (select page_id, url,
  translate(coalesce(regexp_extract(url, '(?s)\A.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
  coalesce(regexp_extract(url, '(?s)\A.*?://([^/?#]*)([^?#]*)', 2), '') as path,
  translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as low
  from pages),
r as (select *, case
  when (host = 'example.net' or host like '%.example.net') and path like '/en/%' then 'example.net/en/'
  when (host = 'example.com' or host like '%.example.com') and path like '/de/%' then 'example.com/de/'
  when (host = 'org' or host like '%.org') and path like '/fr/%' then 'org/fr/'
  when (host = 'net' or host like '%.net') and path like '/%' then 'net/' end as rule,
  case
  when regexp_matches(low, '(?s)(?:[^a-z0-9_.%-]|\z)sponsored=true(?:[^a-z0-9_.%-]|\z)') then '^sponsored=true^'
  when regexp_matches(low, '(?s)(?:[^a-z0-9_.%-]|\z)utm_source=feed(?:[^a-z0-9_.%-]|\z)') then '^utm_source=feed^'
  when regexp_matches(low, '(?s)/cart/checkout(?:[^a-z0-9_.%-]|\z)') then '/cart/checkout^'
  when regexp_matches(low, '(?s)(?:[^a-z0-9_.%-]|\z)doubleclick(?:[^a-z0-9_.%-]|\z)') then '^doubleclick^'
  when contains(low, '/wp-login.php') then '/wp-login.php'
  when regexp_matches(low, '(?s)/robots\.txt(?:[^a-z0-9_.%-]|\z)') then '/robots.txt^'
  when regexp_matches(low, '(?s)(?:[^a-z0-9_.%-]|\z)affiliate=') then '^affiliate=*'
  when regexp_matches(low, '(?s)(?:[^a-z0-9_.%-]|\z)sessionid=') then '^sessionid=*'
  when regexp_matches(low, '(?s)\A[^/?#]*://(?:[^/?#]*[./@])?tracker\.') then '||tracker.'
  when regexp_matches(low, '(?s)\A[^/?#]*://(?:[^/?#]*[./@])?ads\.') then '||ads.' end as found
  from p)
select page_id, host, path, rule,
  case when rule in ('net/', 'example.com/de/') then 'block' when rule is not null then 'allow'
       when found is null or found = '^sponsored=true^' then 'allow' else 'block' end as verdict,
  case when rule is null then found end as pattern
from r
"""
