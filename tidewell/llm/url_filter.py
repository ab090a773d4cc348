"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a host, a path prefix and a verdict (it fits the host and its
subdomains if the path starts with the prefix), or a regular expression over
the URL.  Each rule has literal tokens that any URL it fits must contain as
whole tokens.  The rule is filed under the one of them that is rarest in the
URLs at hand; a URL's tokens fetch the rules filed under them, and only those
run their expression.

Expressions run over "host#path": neither part can hold a ``#``, while both may
hold line feeds, so no rule can take a piece of the path for the host.

Defined cases: a null URL and one without ``://`` have empty host and path and
the method's verdict for them; line feeds are characters like any other; URLs are judged whole and row by row, so
repeated rows and hot hosts need no shuffle; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(r"[a-z0-9]+")
#: Rules that are broadcast at a time; a list of more takes further passes over the URLs.
BLOCK_RULES = 200_000


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


@dataclass(frozen=True)
class SiteRule:
    """A verdict for a host with its subdomains, under a path prefix."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def pattern(self) -> re.Pattern:
        return re.compile(r"(?:[^#]*\.)?" + re.escape(self.host) + "#" + re.escape(self.path))

    @property
    def literals(self) -> list[str]:
        """Tokens that every fitting "host#path" holds whole: a prefix's last token may go on, so it does not count."""
        closed = self.path if not self.path or not _TOKEN.match(self.path[-1].lower()) else re.sub(r"[A-Za-z0-9]+$", "", self.path)
        return _TOKEN.findall(self.host) + _TOKEN.findall(closed.lower())


@dataclass(frozen=True)
class PatternRule:
    """A verdict for URLs that an expression fits, for those no site rule decides; ``literals`` are tokens it implies."""

    name: str
    expression: str
    verdict: str
    literals: list = field(default_factory=list)

    @property
    def pattern(self) -> re.Pattern:
        return re.compile(self.expression)


#: The method's own rules, over "host#path" in the URL's own case: pages that carry no prose.
PATTERN_RULES = [
    PatternRule("login", r"(?is)[^#]*#(?:.*/)?login(?:[/.].*)?$", "block", ["login"]),
    PatternRule("cart", r"(?is)[^#]*#(?:.*/)?cart(?:[/.].*)?$", "block", ["cart"]),
    PatternRule("ads", r"(?is)(?:[^#]*\.)?ads\.[^#]*#", "block", ["ads"]),
    PatternRule("spam", r"(?is)(?:[^#]*[.-])?spam[.-][^#]*#", "block", ["spam"]),
    PatternRule("casino", r"(?is)(?:[^#]*[.-])?casino[.-][^#]*#", "block", ["casino"]),
]


class RuleIndex:
    """Rules filed under their rarest literal token."""

    def __init__(self, site_rules: list[SiteRule], pattern_rules: list[PatternRule], frequency: dict[str, int]):
        self.filed: dict[str, list] = {}
        for rule in [*site_rules, *pattern_rules]:
            if not rule.literals:
                raise ValueError(f"rule {rule.name!r} implies no literal token")
            token = min(rule.literals, key=lambda t: (frequency.get(t, 0), t))
            self.filed.setdefault(token, []).append((isinstance(rule, SiteRule), len(rule.name), rule.name, rule.verdict, rule.pattern))
        self.tried = 0

    def judge(self, host: str, path: str) -> tuple[str | None, str | None]:
        """(rule, verdict): the longest fitting site rule's (of equally long ones the last by name), else the first fitting pattern's verdict, else nothing."""
        subject = f"{host}#{path}"
        best, verdict = None, None
        for token in set(_TOKEN.findall(subject.lower())):
            for site, size, name, says, pattern in self.filed.get(token, ()):
                self.tried += 1
                if site and best and best[:2] >= (size, name) or not pattern.match(subject):
                    continue
                if site:
                    best = size, name, says
                elif verdict is None or says == "block":
                    verdict = says
        return (best[1], best[2]) if best else (None, verdict)


def token_frequency(urls: DataFrame, tokens: set[str]) -> dict[str, int]:
    """URLs that hold each of the rules' tokens, over the whole table; at most one row per token leaves the cluster."""
    held = F.array_intersect(F.split(F.lower(F.concat("host", F.lit("#"), "path")), "[^a-z0-9]+"), F.array(*map(F.lit, sorted(tokens))))
    return {r["token"]: r["n"] for r in urls.select(F.explode(held).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()}


def filter_urls(
    df: DataFrame, site_rules: list[SiteRule], pattern_rules: list[PatternRule] | None = None, id_col: str = "page_id", url_col: str = "url",
    default: str = "allow", no_host: str = "block",
) -> DataFrame:
    """(id, host, path, rule, verdict) of every row."""
    pattern_rules = PATTERN_RULES if pattern_rules is None else pattern_rules
    url = F.col(url_col)
    urls = df.select(F.col(id_col).cast("long").alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    # rules in blocks; patterns come last, for URLs that no site rule decides
    blocks = [(site_rules[k : k + BLOCK_RULES], []) for k in range(0, len(site_rules), BLOCK_RULES)]
    blocks += [([], pattern_rules[k : k + BLOCK_RULES]) for k in range(0, len(pattern_rules), BLOCK_RULES)]
    if len(site_rules) + len(pattern_rules) <= BLOCK_RULES:
        blocks = [(site_rules, pattern_rules)]
    out = urls.select("*", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    for sites, patterns in blocks:
        out = _judged(out, sites, patterns, token_frequency(urls, {t for r in [*sites, *patterns] for t in r.literals}))
    return out.withColumn("verdict", F.coalesce("verdict", F.when(F.col("host") == "", no_host).otherwise(default)))


def _judged(urls: DataFrame, sites: list[SiteRule], patterns: list[PatternRule], frequency: dict[str, int]) -> DataFrame:
    """One pass: a longer rule replaces what earlier passes found, a pattern's verdict stands where no rule fits."""
    shared = urls.sparkSession.sparkContext.broadcast((sites, patterns, frequency))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = RuleIndex(*shared.value)
        for batch in batches:
            rules, verdicts = [], []
            for host, path, rule, verdict in zip(*(batch.column(k).to_pylist() for k in range(1, 5))):
                found, says = index.judge(host, path)
                if found is not None and (rule is None or (len(found), found) > (len(rule), rule)):
                    rule, verdict = found, says
                elif rule is None and says is not None and verdict != "block":
                    verdict = says
                rules.append(rule)
                verdicts.append(verdict)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(rules, pa.string()), pa.array(verdicts, pa.string())], ["id", "host", "path", "rule", "verdict"])

    return urls.mapInArrow(judge, "id long, host string, path string, rule string, verdict string")
