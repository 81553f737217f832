"""URL filters: rules indexed by their rarest literal token, fetched by the URL's tokens."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from blotter.llm.columns import others

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_RULE_BYTES = 16 * 1024 * 1024
_EDGE = "[^A-Za-z0-9]"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a regular expression over host and path; ``tokens`` are complete
    tokens of every text it matches."""

    name: str
    verdict: str
    scoped: bool
    pattern: str
    tokens: tuple[str, ...]


def _tokens(text: str) -> list[str]:
    return [t for t in re.split(r"[^a-z0-9]+", text.lower()) if t]


def host_rule(name: str, verdict: str) -> Rule:
    """``host/path``: fits the host and its subdomains where the path starts with the rule's."""
    host, _, path = name.partition("/")
    whole = _tokens(name)
    if path and path[-1].isalnum():  # the last token may go on in the URL
        whole = whole[:-1]
    return Rule(name, verdict, True, f"^([^/]*\\.)?{re.escape(host)}/{re.escape(path)}", tuple(whole))


def glob_rule(name: str, verdict: str) -> Rule:
    """A text with ``*`` for anything, bounded by token edges, anywhere in host or path.

    Tokens next to a ``*`` may go on in the URL and are no complete tokens.
    """
    parts = name.split("*")
    body = ".*".join(re.escape(p) for p in parts)
    whole = []
    for i, part in enumerate(parts):
        inner = part
        if i:
            inner = re.sub(r"^[A-Za-z0-9]+", "", inner)
        if i < len(parts) - 1:
            inner = re.sub(r"[A-Za-z0-9]+$", "", inner)
        whole += _tokens(inner)
    return Rule(name, verdict, False, f"(?i)(^|{_EDGE}){body}({_EDGE}|$)", tuple(whole))


def _parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def _rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    if sum(len(r.name) + len(r.pattern) + 64 for r in rules) > MAX_RULE_BYTES:
        raise ValueError(f"the rules exceed {MAX_RULE_BYTES} bytes; filter in several passes")
    rows = [
        F.struct(
            F.lit(r.name).alias("_name"), F.lit(r.verdict).alias("_verdict"),
            F.lit(r.scoped).alias("_scoped"), F.lit(r.pattern).alias("_pattern"),
            # A rule without a complete token is fetched by every URL.
            F.array(*map(F.lit, r.tokens or ("",))).alias("_tokens"),
        )
        for r in rules
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def filter_urls(pages: DataFrame, rules: list[Rule], default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict of its column ``url``.

    Every distinct URL is judged once. Its tokens fetch the rules indexed under them (each
    rule under the one of its complete tokens that the fewest URLs of all hold), and only
    those run as regular expressions. The longest fitting host rule decides and is named
    in ``rule``; without one ``rule`` is null and the longest fitting glob rule decides,
    else ``default``. Ties go to the greater name. The rules are broadcast, at most
    ``MAX_RULE_BYTES``.

    A null URL, or one without ``://``, has empty host and path and gets the default.
    Repeated rows are judged alike. Input columns named host, path, rule or verdict are
    replaced; others are kept.
    """
    kept = others(pages.columns, ("host", "path", "rule", "verdict"))
    rules_table = _rule_table(pages.sparkSession, rules)
    host, path = _parts(F.col("_url"))
    urls = (
        pages.select(F.col("url").alias("_url")).distinct()
        .where(F.col("_url").contains("://"))
        .withColumns({"_host": host, "_path": path})
        .withColumn("_subject", F.concat("_host", "_path"))
    )
    tokens = F.array_distinct(
        F.concat(
            F.split(F.translate("_subject", UPPER, LOWER), "[^a-z0-9]+"), F.array(F.lit(""))
        )
    )
    held = urls.select("_url", "_subject", F.explode(tokens).alias("_token"))
    wanted = rules_table.select(F.explode("_tokens").alias("_token")).distinct()
    counts = held.join(F.broadcast(wanted), "_token").groupBy("_token").count()
    index = (
        rules_table.withColumn("_token", F.explode("_tokens"))
        .join(F.broadcast(counts), "_token", "left")  # one row per rule token at most
        .groupBy("_name", "_verdict", "_scoped", "_pattern")
        .agg(F.min(F.struct(F.coalesce("count", F.lit(0)), F.col("_token"))).alias("_best"))
        .select("_name", "_verdict", "_scoped", "_pattern", F.col("_best._token").alias("_token"))
    )
    judged = (
        held.join(F.broadcast(index), "_token")
        .where(F.regexp(F.col("_subject"), F.col("_pattern")))
        .groupBy("_url")
        .agg(F.max(F.struct("_scoped", F.length("_name"), "_name", "_verdict")).alias("_r"))
    )
    host, path = _parts(F.col("url"))
    return (
        pages.select(*kept)
        .join(judged, pages["url"] == judged["_url"], "left")
        .select(
            *kept,
            F.coalesce(host, F.lit("")).alias("host"),
            F.coalesce(path, F.lit("")).alias("path"),
            F.when(F.col("_r._scoped"), F.col("_r._name")).alias("rule"),
            F.coalesce("_r._verdict", F.lit(default)).alias("verdict"),
        )
    )
