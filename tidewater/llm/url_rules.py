"""URL filters: pattern rules found through their rarest literal token.

A rule is a regular expression over host and path with the literal tokens that every match
holds whole. Each rule is indexed under that of its tokens which is rarest among the URLs;
a URL's tokens fetch candidate rules by a join, and only those run their expression. All of
it is DataFrame work; each distinct URL is judged once.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN = "[A-Za-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is matched against host and path joined; every match holds all
    ``tokens`` as whole runs of letters and digits. Of matching rules the highest ``rank``
    wins, then the name that sorts last."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    rank: int

    def __post_init__(self):
        if not self.tokens:
            raise ValueError(f"rule {self.name} has no literal token to index it by")


def host_rule(verdict: str, rule: str) -> Rule:
    """A rule like ``example.org/en/1``: fits the host and its subdomains if the path starts
    with the rule's. The longest such rule wins, before all pattern rules."""
    host, slash, path = rule.partition("/")
    whole = re.findall(TOKEN, host)
    inner = re.match(r".*[^A-Za-z0-9]", slash + path, re.S)  # the last token may go on in a URL's path
    whole += re.findall(TOKEN, inner[0]) if inner else []
    quoted = re.sub(r"([^A-Za-z0-9/])", r"\\\1", rule)
    return Rule(rule, verdict, rf"^([^/]*\.)?{quoted}", tuple(whole), 1_000_000 + len(rule))


def pattern_rule(verdict: str, pattern: str, tokens: Sequence[str]) -> Rule:
    return Rule(pattern, verdict, pattern, tuple(tokens), 0)


#: Rules of the method itself, for URLs that no host rule fits: paths of no text worth having.
PATTERN_RULES = (
    pattern_rule("block", r"^[^/]*/(.*/)?login(/.*)?$", ["login"]),
    pattern_rule("block", r"^[^/]*/(.*/)?cart(/.*)?$", ["cart"]),
    pattern_rule("block", r"^[^/]*/(.*/)?checkout(/.*)?$", ["checkout"]),
    pattern_rule("block", r"^[^/]*/(.*/)?wp-admin(/.*)?$", ["wp", "admin"]),
    pattern_rule("block", r"^[^/]*/(.*/)?cgi-bin/", ["cgi", "bin"]),
    pattern_rule("block", r"^(.*\.)?doubleclick\.", ["doubleclick"]),
    pattern_rule("block", r"^(ads|adserver)\..*/", ["ads"]),
    pattern_rule("block", r"^adserver\.", ["adserver"]),
    pattern_rule("block", r"^([^/]*\.)?ads-track\.", ["ads", "track"]),
    pattern_rule("block", r"^[^/]*/(.*/)?porn(/.*)?$", ["porn"]),
    pattern_rule("block", r"^[^/]*/(.*/)?casino(/.*)?$", ["casino"]),
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased)
    and path (then up to ``?``, ``#`` or the end); both empty for null or without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def rule_index(spark: SparkSession, rules: Sequence[Rule], tokens: DataFrame) -> DataFrame:
    """The rules, each with the one of its tokens that ``tokens`` (column ``token``) has least
    often; ties go to the first in the alphabet."""
    own = spark.createDataFrame([(i, r.name, r.verdict, r.pattern, r.rank, t) for i, r in enumerate(rules) for t in r.tokens],
                                "id int, name string, verdict string, pattern string, rank int, token string")
    counts = tokens.join(own.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    return (own.join(counts, "token", "left").groupBy("id", "name", "verdict", "pattern", "rank")
            .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("rarest"))
            .select("name", "verdict", "pattern", "rank", F.col("rarest.token").alias("token")))


def judge_urls(pages: DataFrame, rules: Sequence[Rule], default: str = "allow", url_col: str = "url") -> DataFrame:
    """``pages`` and the columns ``host``, ``path``, ``rule`` (the winning rule's name, null if
    none fits) and ``verdict`` (that rule's, else ``default``).

    A null URL or one without ``://`` has an empty host and path and gets ``default``;
    repeated rows get the same verdict; an empty table stays empty; columns of ``pages`` that
    have one of the four names are replaced.
    """
    spark = pages.sparkSession
    host, path = url_parts(F.col(url_col))
    urls = pages.select(F.col(url_col).alias("_url")).where("_url is not null").distinct()
    host_u, path_u = url_parts(F.col("_url"))
    urls = urls.select("_url", F.concat(host_u, path_u).alias("_key"))
    tokens = urls.select("_url", "_key", F.explode(F.array_distinct(F.regexp_extract_all("_key", F.lit(f"({TOKEN})"), 1))).alias("token"))
    # The index has a row for each rule; Spark broadcasts it if its size allows.
    hits = tokens.join(rule_index(spark, rules, tokens), "token").where("_key rlike pattern")
    best = hits.groupBy("_url").agg(F.max(F.struct("rank", "name", "verdict")).alias("_best"))
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    return (pages.withColumn("_url", F.col(url_col)).join(best, "_url", "left")
            .select(*kept, host.alias("host"), path.alias("path"), F.col("_best.name").alias("rule"),
                    F.coalesce("_best.verdict", F.lit(default)).alias("verdict")))
