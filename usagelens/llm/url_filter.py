"""URL filters by pattern rules, indexed by their rarest literal token.

A rule is a regular expression over host and path, with the literal tokens (runs of letters and digits)
that every URL it fits must hold. Token counts over all URLs say which of a rule's tokens is rarest; the
rule is filed under that one. A URL's tokens fetch the rules filed under them, and only those run.
Rules without a token run on every URL.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import LlmError, pieces, with_columns

TOKEN = r"[A-Za-z0-9]+"
MAX_RULE_BYTES = 64 << 20


@dataclass(frozen=True)
class Rule:
    """`name` as reported, the verdict, a pattern searched in host + path, its literal tokens, its rank.

    Of the rules that fit, the one of the highest rank wins, then the smallest name.
    """

    name: str | None
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    rank: int


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits the host and its subdomains where the path starts with `path`; longer rules win."""
    # The path's last token may go on in the URL, so it doesn't count unless something ends it.
    whole = re.findall(TOKEN, host) + [m[0] for m in re.finditer(TOKEN, path) if m.end() < len(path)]
    # Host and path can't be mistaken for each other: a host holds no slash, a path starts with one.
    return Rule(host + path, verdict, rf"^(?:[^/]*\.)?{re.escape(host + path)}", tuple(whole), len(host + path))


def token_rule(verdict: str, token: str) -> Rule:
    """Fits where a token stands in the host; without a name, and weaker than any host rule."""
    return Rule(None, verdict, rf"^[^/]*(?<![A-Za-z0-9]){re.escape(token)}(?![A-Za-z0-9])", (token,), 0)


#: The rules of the query, and below them the method's own list for URLs that no rule fits.
HOST_RULES = (
    host_rule("allow", "org", "/"),
    host_rule("block", "example.org", "/es/"),
    host_rule("block", "example.org", "/en/1"),
    host_rule("allow", "com", "/fr/"),
    host_rule("block", "com", "/de/"),
)
TOKEN_RULES = tuple(token_rule("block", t) for t in ("adult", "casino", "porn", "spam", "warez", "xxx"))
DEFAULT = "allow"


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z in lower case; empty where there is none."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def token_counts(urls: DataFrame, tokens: list[str]) -> dict[str, int]:
    """In how many of the URLs (host, path) each of the rules' tokens stands."""
    if not tokens:
        return {}
    found = F.array_distinct(F.regexp_extract_all(F.concat("host", "path"), F.lit(TOKEN), 0))
    wanted = F.array_intersect(found, F.array(*[F.lit(t) for t in tokens]))
    counts = urls.select(F.explode(wanted).alias("token")).groupBy("token").count()
    return {row["token"]: row["count"] for row in counts.collect()}  # one row a rule token at most


def file_rules(rules: Sequence[Rule], counts: dict[str, int]) -> dict[str | None, list[Rule]]:
    """Rules by their rarest token, those without one under None."""
    index: dict[str | None, list[Rule]] = {}
    for rule in rules:
        rarest = min(rule.tokens, key=lambda t: (counts.get(t, 0), t), default=None)
        index.setdefault(rarest, []).append(rule)
    return index


def best_rule(subject: str, index: dict[str | None, list[Rule]]) -> Rule | None:
    """The winning rule for a host and path, running only the rules that its tokens fetch."""
    best = None
    for token in [None, *set(re.findall(TOKEN, subject))]:
        for rule in index.get(token, ()):
            wins = best is None or (-rule.rank, rule.name or "") < (-best.rank, best.name or "")
            if wins and re.search(rule.pattern, subject):
                best = rule
    return best


def judge(pages: DataFrame, rules: Sequence[Rule] = HOST_RULES + TOKEN_RULES, default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule, verdict for each row of `pages` (page_id, url).

    A null url or one without :// has an empty host and path, which no rule with tokens fits, and so gets
    the default. Rows may repeat, ids may be null; extra columns are ignored. An empty list of rules gives
    the default everywhere. Rules are sent to every task, so they may hold `MAX_RULE_BYTES` at most.
    """
    if sum(len(r.pattern) + sum(map(len, r.tokens)) for r in rules) > MAX_RULE_BYTES:
        raise LlmError("too many rules for every task to hold")
    urls = with_columns(pages, "page_id", "url").select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    index = file_rules(rules, token_counts(urls, sorted({t for r in rules for t in r.tokens})))
    tables = pages.sparkSession.sparkContext.broadcast(index)
    id_type = urls.schema["page_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "path"):
                subjects = zip(part.column("host").to_pylist(), part.column("path").to_pylist())
                best = [best_rule(host + path, tables.value) for host, path in subjects]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pa.array([r.name if r else None for r in best], pa.string()),
                        pa.array([r.verdict if r else default for r in best], pa.string()),
                    ],
                    names=["page_id", "host", "path", "rule", "verdict"],
                )

    return urls.mapInArrow(run, f"page_id {id_type}, host string, path string, rule string, verdict string")
