"""URL filter: pattern rules indexed by their rarest literal token.

A rule is a regular expression over ``host + path`` together with the literal tokens that every text it matches must
contain. Each rule is filed under the one of its tokens that is rarest among the URLs at hand. A URL's own tokens fetch
the rules filed under them, and only those run as regular expressions.

Only DataFrame functions are used; no step depends on the number of rules or URLs.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.operators.joins import split_key

#: First ``://``, then the host up to ``/``, ``?``, ``#`` or the end, then the path up to ``?``, ``#`` or the end.
URL_PATTERN = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """``pattern`` matches ``host + path``; every match holds all of ``tokens`` as whole tokens.

    ``label`` names a site rule, whose longest match decides; a rule without one belongs to the pattern list, which
    decides where no site rule fits (any blocking pattern blocks).
    """

    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    label: str | None = None


def _tokens(text: str) -> list[str]:
    return [token for token in re.split("[^a-z0-9]+", text.translate(_LOWER)) if token]


_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def site_rule(verdict: str, host: str, path: str) -> Rule:
    """A rule for ``host`` and its subdomains, for paths that start with ``path``.

    The last token of the path may go on in a URL, so it counts as a literal token only if something ends it.
    """
    literal = _tokens(host) + _tokens(re.sub("[A-Za-z0-9]+$", "", path))
    pattern = rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}"
    return Rule(verdict, pattern, tuple(dict.fromkeys(literal)), host + path)


def word_rule(verdict: str, word: str) -> Rule:
    """A rule for URLs that hold ``word`` as a whole token of host or path, in any case."""
    return Rule(verdict, rf"(?i)(?:^|[^A-Za-z0-9]){re.escape(word)}(?:$|[^A-Za-z0-9])", (word,))


#: Site rules that production runs with.
SITE_RULES = (
    site_rule("allow", "org", "/"),
    site_rule("block", "example.org", "/es/"),
    site_rule("block", "example.org", "/en/1"),
    site_rule("allow", "com", "/fr/"),
    site_rule("block", "com", "/de/"),
)

#: Words that mark adult, gambling and account pages, for URLs without a site rule.
PATTERN_RULES = tuple(
    word_rule("block", word)
    for word in "porn xxx casino poker viagra login signin signup checkout cart captcha doubleclick".split()
)

DEFAULT_RULES = SITE_RULES + PATTERN_RULES


def rules_frame(spark: SparkSession, rules: Iterable[Rule]) -> DataFrame:
    """The rules as a frame (label, verdict, pattern, tokens), made by an SQL list of values."""
    rules = list(rules)
    if not rules:
        return spark.sql(
            "SELECT '' AS label, '' AS verdict, '' AS pattern, array('') AS tokens FROM range(1) WHERE id < 0"
        )
    # Named parameters: an inline table doesn't keep the order of positional ones.
    arguments, rows = {}, []
    for n, rule in enumerate(rules):
        named = {f"label{n}": rule.label, f"verdict{n}": rule.verdict, f"pattern{n}": rule.pattern}
        named[f"words{n}"] = " ".join(rule.tokens)
        arguments.update(named)
        rows.append("(" + ", ".join(f":{name}" for name in named) + ")")
    listed = spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t(label, verdict, pattern, words)", args=arguments)
    return listed.select("label", "verdict", "pattern", F.split("words", " ").alias("tokens"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for NULL and for a text without ``://``."""
    text = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(text, URL_PATTERN, 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(text, URL_PATTERN, 2)


def url_tokens(text: Column) -> Column:
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.array_distinct(F.split(lowered, "[^a-z0-9]+")), lambda token: token != "")


def index_rules(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """File each rule under its rarest token. ``tokens`` has one row (token) for each URL that holds it.

    Ties go to the first token in order. A token that no URL holds has count zero: its rules fetch nothing, as they
    cannot match.
    """
    literal = rules.select("*", F.explode("tokens").alias("token"))
    wanted = literal.select(F.col("token").alias("wanted")).distinct()
    counts = tokens.join(wanted, split_key(tokens["token"], wanted["wanted"]), "left_semi")
    counts = counts.groupBy("token").agg(F.count(F.lit(1)).alias("urls"))
    ranked = literal.join(counts, "token", "left")
    rarest = F.min(F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), "token")).alias("rarest")
    return ranked.groupBy("label", "verdict", "pattern").agg(rarest).select(
        "label", "verdict", "pattern", F.col("rarest.token").alias("indexed")
    )


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """One row per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict.

    ``rule`` is the longest site rule that fits (ties: a blocking one first, then in order of text), else NULL, and
    its verdict holds. Else a blocking pattern blocks, and ``default`` holds for the rest.

    NULL or malformed urls have an empty host and path and match no rule. Repeated rows and NULL ids stay as they are.
    Only ``page_id`` and ``url`` are read, whatever other columns there are; an empty table gives an empty result.
    """
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    urls = urls.withColumn("target", F.concat("host", "path"))
    # The many URLs of one page template are judged once.
    targets = urls.select("target").distinct().select("target", F.explode(url_tokens(F.col("target"))).alias("token"))
    index = index_rules(rules, targets.select("token"))
    fetched = targets.join(index, split_key(targets["token"], index["indexed"]))
    matched = fetched.where("target RLIKE pattern")
    site = F.col("label").isNotNull()
    order = F.struct(F.length("label"), (F.col("verdict") == "block"), F.col("label"))
    hits = matched.groupBy(F.col("target").alias("hit")).agg(
        F.max_by(F.when(site, F.struct("label", "verdict")), F.when(site, order)).alias("site"),
        F.coalesce(F.max(~site & (F.col("verdict") == "block")), F.lit(False)).alias("blocked"),
    )
    judged = urls.join(hits, split_key(urls["target"], hits["hit"]), "left")
    fallback = F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit(default))
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("site.label").alias("rule"),
        F.coalesce(F.col("site.verdict"), fallback).alias("verdict"),
    )
