"""Verdicts on addresses: listed hosts and paths first, then pattern rules found by their rarest literal token.

A pattern rule is text with three signs: ``||`` at the start stands for the scheme and any subdomains, ``*`` for any
characters and ``^`` for a separator or the end. Its tokens are the runs of letters and digits that any matching address
must hold as whole runs. Each rule is filed under the one of its tokens that the fewest addresses hold; the tokens
of an address fetch its candidate rules, and only their regular expressions run.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm import common

#: Verdict and rule; the host ends at the first slash, the path is the rest.
LISTED = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Pattern rules that block.
PATTERNS = (
    "||doubleclick.net^", "||ads.*^banner^", "/adserver/", "/ads/*", "^track^", "&utm_source=*", "?utm_source=*", "^login^", "^signup^",
    "/cart/checkout", "^casino^", "^xxx^", "&sessionid=", "?sessionid=", "/wp-admin/", "/cgi-bin/*", ".exe^", "^redirect=http*",
    "?page=9&ref=x", "/calendar/*month=", "^print=1^", "/feed/rss", "^amp^*^share^", "||cdn.*/pixel.gif",
)

_SEPARATOR = r"[^A-Za-z0-9%._-]"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def listed_rule(host: Column, path: Column, listed=LISTED) -> Column:
    """The longest rule whose host is this host or one above it, and whose path starts this path; else null."""
    cases = F
    for _, rule in sorted(listed, key=lambda r: (-len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        cases = cases.when(fits, rule)
    return cases.otherwise(F.lit(None).cast("string")) if listed else F.lit(None).cast("string")


def regex_of(pattern: str) -> str:
    """The regular expression of a pattern rule, for addresses in lower case."""
    anchored = pattern.startswith("||")
    body = pattern[2:] if anchored else pattern
    signs = {"*": ".*", "^": f"(?:{_SEPARATOR}|$)"}
    return (r"^[a-z][a-z0-9+.-]*://(?:[^/?#]*\.)?" if anchored else "") + "".join(signs.get(c) or re.escape(c) for c in body.lower())


def tokens_of(pattern: str) -> list[str]:
    """Runs of letters and digits that each matching address holds as whole runs: bounded by another sign on both sides."""
    anchored = pattern.startswith("||")
    body = pattern[2:].lower() if anchored else pattern.lower()
    found = []
    for run in re.finditer(r"[a-z0-9]+", body):
        before, after = body[: run.start()][-1:], body[run.end() :][:1]
        # without a sign before it, an anchored run follows a dot or slash; one at the end or by a star may go on
        if (before and before != "*" or anchored and not before) and after and after != "*":
            found.append(run[0])
    return found


def token_counts(urls: DataFrame, wanted: list[str]) -> dict[str, int]:
    """How many addresses hold each of the rules' tokens, over all addresses; there are no more than the rules have."""
    tokens = F.array_distinct(F.split(F.lower(F.coalesce("url", F.lit(""))), "[^a-z0-9]+"))
    counted = urls.select(F.explode(tokens).alias("token")).where(F.col("token").isin(wanted)).groupBy("token").count()
    return {r["token"]: r["count"] for r in counted.collect()}


def rule_index(patterns, counts: dict[str, int]) -> tuple[dict[str, list[int]], list[int]]:
    """The rules under their rarest token (ties: the longer, then the first by name), and those without any token."""
    index: dict[str, list[int]] = {}
    rest = []
    for i, pattern in enumerate(patterns):
        tokens = tokens_of(pattern)
        if tokens:
            index.setdefault(min(tokens, key=lambda t: (counts.get(t, 0), -len(t), t)), []).append(i)
        else:
            rest.append(i)
    return index, rest


def judge(pages: DataFrame, listed=LISTED, patterns=PATTERNS) -> DataFrame:
    """page_id, host, path, rule, verdict and pattern (the first pattern rule that matches, else null) of every row.

    The verdict is the listed rule's where one fits; else block where a pattern rule matches, and allow where none does,
    null and empty addresses among them. Every row gives a row, repeated ones too; other columns take no part.
    """
    urls = pages.select("page_id", F.col("url").cast("string").alias("url"))
    wanted = sorted({t for p in patterns for t in tokens_of(p)})
    index, rest = rule_index(patterns, token_counts(urls, wanted) if wanted else {})
    verdicts = {rule: verdict for verdict, rule in listed}

    def make():
        compiled = [re.compile(regex_of(p), re.DOTALL) for p in patterns]
        split = re.compile(r"[a-z0-9]+")

        def of(texts: list[bytes]) -> list:
            out = []
            for raw in texts:
                url = ascii_lower(raw)
                candidates = {i for token in set(split.findall(url)) & index.keys() for i in index[token]}
                out.append(next((patterns[i] for i in sorted(candidates.union(rest)) if compiled[i].search(url)), None))
            return [pa.array(out, pa.string())]

        return of

    host, path = host_of(F.col("url")), path_of(F.col("url"))
    ruled = urls.select("page_id", host.alias("host"), path.alias("path"), listed_rule(host, path, listed).alias("rule"), "url")
    matched = common.over_texts(ruled, make, "pattern string", "url")
    by_rule = F.lit(None).cast("string")
    for rule, verdict in verdicts.items():
        by_rule = F.when(F.col("rule") == rule, verdict).otherwise(by_rule)
    by_pattern = F.when(F.col("pattern").isNull(), "allow").otherwise("block")
    return matched.select("page_id", "host", "path", "rule", F.coalesce(by_rule, by_pattern).alias("verdict"), "pattern")


def ascii_lower(raw: bytes) -> str:
    """A-Z in lower case, all else as it is; line ends become spaces, so that a rule's end is the address's end."""
    return raw.lower().replace(b"\n", b" ").decode()
