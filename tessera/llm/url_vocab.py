"""URL filter: host rules first, then a weighted vocabulary matched with one Aho-Corasick pass.

A url is rejected by one STRICT term or by several DISTINCT soft terms. A term
counts only between boundaries: the bytes before and after it must not be ASCII
letters or digits (``sex`` does not match ``essex``).
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import add_struct

# The vocabulary in use. One strict term rejects; soft terms must meet.
STRICT = ("adult", "betting", "bets", "camgirls", "casino", "escorts", "hentai", "lottery", "milf", "nude", "nudes",
          "phishing", "poker", "porn", "porno", "sex", "slots", "torrent", "viagra", "warez", "xxx")
SOFT = ("bet", "bonus", "cheap", "click", "coupon", "crack", "dating", "deal", "discount", "download", "earn", "free",
        "girls", "hot", "jackpot", "keygen", "loan", "lucky", "pills", "prize", "promo", "sexy", "spin", "win", "winner")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HITS = T.StructType([T.StructField("strict", T.ArrayType(T.StringType())), T.StructField("soft", T.ArrayType(T.StringType()))])


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host and its subdomains where the path starts with ``path``."""
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; empty for null or no ``://``."""
    at = F.instr(url, "://")
    rest = F.substr(url, at + 3)
    return F.when(at > 0, F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)).otherwise("")


def path_of(url: Column) -> Column:
    """From the end of the host up to ``? #`` or the end; empty for null or no ``://``."""
    at = F.instr(url, "://")
    rest = F.substr(url, at + 3)
    return F.when(at > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest fitting rule, null if none fits (ties: the earlier rule)."""
    name = verdict = None
    for r in sorted(rules, key=lambda r: -len(r.name)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        name = F.when(fits, r.name) if name is None else name.when(fits, r.name)
        verdict = F.when(fits, r.verdict) if verdict is None else verdict.when(fits, r.verdict)
    null = F.lit(None).cast("string")
    return (null, null) if name is None else (name, verdict)


@functools.lru_cache(maxsize=8)
def _automaton(strict: tuple, soft: tuple):
    import ahocorasick

    a = ahocorasick.Automaton()
    for kind, terms in (("soft", soft), ("strict", strict)):  # a term in both lists is strict
        for t in terms:
            a.add_word(t.lower(), (kind, t.lower()))
    if len(a):
        a.make_automaton()
    return a


def term_hits(url: str | None, strict: tuple = STRICT, soft: tuple = SOFT) -> tuple[list[str], list[str]]:
    """Distinct strict and soft terms of one url, sorted. Null or empty: none."""
    a = _automaton(strict, soft)
    if not url or not len(a):
        return [], []
    low = url.lower()
    found: dict[str, set] = {"strict": set(), "soft": set()}
    for end, (kind, term) in a.iter(low):
        before, after = end - len(term), end + 1
        if (before < 0 or not _word(low[before])) and (after >= len(low) or not _word(low[after])):
            found[kind].add(term)
    return sorted(found["strict"]), sorted(found["soft"])


def _word(c: str) -> bool:
    return c.isascii() and c.isalnum()


def judge_urls(df: DataFrame, rules: list[Rule], url_col: str = "url", strict: tuple = STRICT, soft: tuple = SOFT,
               min_soft: int = 2, out: str = "judged") -> DataFrame:
    """``df`` and a struct ``out``: host, path, rule, verdict, strict, soft.

    verdict is the rule's where one fits, else ``block`` for one strict term or
    ``min_soft`` distinct soft ones, else ``allow``. A null or empty url has
    empty host and path, no rule and no hits: it is allowed. An empty table
    gives an empty table.
    """
    strict, soft = tuple(strict), tuple(soft)

    def hits(urls: list) -> dict[str, list]:
        got = [term_hits(u, strict, soft) for u in urls]
        return {"strict": [s for s, _ in got], "soft": [s for _, s in got]}

    hit = add_struct(df, url_col, out, HITS, hits, keep=list(dict.fromkeys([*df.columns, url_col])), as_bytes=False)
    url, host, path = F.col(f"`{url_col}`"), host_of(F.col(f"`{url_col}`")), path_of(F.col(f"`{url_col}`"))
    name, verdict = rule_of(host, path, rules)
    blocked = (F.size(f"{out}.strict") > 0) | (F.size(f"{out}.soft") >= min_soft)
    return hit.withColumn(out, F.struct(
        host.alias("host"), path.alias("path"), name.alias("rule"),
        F.coalesce(verdict, F.when(blocked, "block").otherwise("allow")).alias("verdict"),
        F.col(f"{out}.strict").alias("strict"), F.col(f"{out}.soft").alias("soft")))
