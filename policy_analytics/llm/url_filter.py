"""Operator 5: URL filters indexed by their rarest literal token.

Every rule becomes a regular expression and a list of literal tokens that any url it fits
must contain whole. The rule is filed under the token that is rarest among all urls of the
table; the tokens of a url then fetch its candidate rules, and only those run their
expressions. Rules without a literal token are candidates of every url.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_frame, table

MAX_RULES = 100_000        # rules travel to every task
TOKEN = re.compile(r"[a-z0-9]+")


@dataclass(frozen=True)
class Rule:
    """``host`` with its subdomains and a path prefix, or a ``pattern`` over the lower-cased
    url in which ``*`` stands for any characters."""

    action: str
    host: str = ""
    path: str = ""
    pattern: str = ""

    @property
    def name(self) -> str:
        return self.pattern or self.host + self.path

    def expression(self) -> str:
        if self.pattern:
            return ".*".join(re.escape(p) for p in self.pattern.split("*"))
        return rf"(?:[^/]*\.)?{re.escape(self.host)}{re.escape(self.path)}"

    def tokens(self) -> list[str]:
        """Literal tokens that are whole tokens of any url the rule fits."""
        if not self.pattern:
            # the host ends at the path's slash; the path's last token may go on in the url
            lowered = (self.host + self.path).lower()
            found = list(TOKEN.finditer(lowered))
            return [m[0] for m in found if m.end() < len(lowered)]
        return [m[0] for part in self.pattern.split("*") for m in TOKEN.finditer(part)
                if 0 < m.start() and m.end() < len(part)]


# The rules of the query.
HOST_RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)
# What decides when none of them fits: addresses of advertising and tracking.
PATTERN_RULES = (
    Rule("block", pattern="/ads/"),
    Rule("block", pattern="/adserver/"),
    Rule("block", pattern="/banner/*.gif"),
    Rule("block", pattern="/tracking/pixel."),
    Rule("block", pattern="://tracker.*/collect?"),
)


def host(url):
    """After the first ``://`` up to / ? # or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path(url):
    """After the host up to ? # or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rarest_tokens(urls: DataFrame, url: str, rules: list[Rule]) -> dict[str, list[Rule]]:
    """The index: token -> rules, each rule under its rarest token among all urls.

    Only tokens of rules are counted, so the counts that come to the driver are bounded by
    the rules.
    """
    wanted = sorted({t for r in rules for t in r.tokens()})
    counts: dict[str, int] = {}
    if wanted:
        mine = F.broadcast(small_frame(urls.sparkSession, [(t,) for t in wanted], "token string"))
        lowered = F.lower(F.coalesce(F.col(url), F.lit("")))
        every = urls.select(F.explode(F.array_distinct(F.regexp_extract_all(lowered, F.lit(TOKEN.pattern), F.lit(0)))).alias("token"))
        counts = {r["token"]: r["count"] for r in every.join(mine, "token").groupBy("token").count().collect()}
    index = defaultdict(list)
    for r in rules:
        index[min(r.tokens(), key=lambda t: (counts.get(t, 0), t), default="")].append(r)
    return dict(index)


def judge(urls: DataFrame, url: str = "url", keep: tuple[str, ...] = (), host_rules=HOST_RULES, pattern_rules=PATTERN_RULES,
          default: str = "allow") -> DataFrame:
    """``(*keep, host, path, rule, pattern, verdict)`` for every row.

    The longest host rule that fits decides; without one, the first pattern rule that fits,
    else ``default``. A null url and one without ``://`` have empty host and path. Repeated
    rows are judged each; an empty table gives an empty result.
    """
    if len(host_rules) + len(pattern_rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    spots = rarest_tokens(urls, url, [*host_rules, *pattern_rules])
    rank = {r: i for i, r in enumerate(pattern_rules)}

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compiled = {t: [(r, re.compile(r.expression(), re.S)) for r in rules] for t, rules in spots.items()}
        everywhere = compiled.pop("", [])
        for b in batches:
            rules, patterns, verdicts = [], [], []
            for u, h, p in zip(b["__url"], b["host"], b["path"], strict=True):
                low = (u or "").lower()
                best, pattern = None, None
                candidates = [c for t in set(TOKEN.findall(low)) if t in compiled for c in compiled[t]] + everywhere
                for r, x in candidates:
                    if r.pattern:
                        if (pattern is None or rank[r] < rank[pattern]) and x.search(low):
                            pattern = r
                    elif (best is None or len(r.name) > len(best.name)) and x.match(h + p):
                        best = r
                rules.append(best.name if best else None)
                patterns.append(pattern.name if pattern else None)
                verdicts.append((best or pattern).action if best or pattern else default)
            out = b.drop(columns="__url")
            yield out.assign(rule=rules, pattern=patterns, verdict=verdicts)

    kept = urls.select(*keep, F.col(url).alias("__url"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "__url")
    return kept.mapInPandas(judged, f"{kinds}, rule string, pattern string, verdict string")


def op5_token_indexed_url_rules(spark, sf_dir: str) -> DataFrame:
    """The verdict on the url of every row of ``pages``."""
    return judge(table(spark, sf_dir, "pages"), keep=("page_id",)).drop("pattern")


ORACLE = r"""
WITH u AS (
  SELECT page_id, lower(coalesce(url, '')) AS low,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM u)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN contains(low, '/ads/') OR contains(low, '/adserver/') OR contains(low, '/tracking/pixel.')
         OR regexp_matches(low, '(?s)/banner/.*\.gif') OR regexp_matches(low, '(?s)://tracker\..*/collect\?') THEN 'block'
       ELSE 'allow' END AS verdict
FROM r
"""
