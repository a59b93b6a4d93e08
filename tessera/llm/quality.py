"""Quality rules as a bitmask ledger.

Every rule is evaluated once for each document; the ledger stores the
measurements and one bit for each failed rule. Policies (versioned masks) are
applied to the stored bits, and ablations are bitwise aggregations over them:
neither reads a text again.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import add_struct

SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper_words")
LEDGER = T.StructType([*(T.StructField(m, T.LongType()) for m in MEASURES), T.StructField("failed", T.LongType())])


@dataclass(frozen=True)
class Rule:
    """``fails`` gets the measurements by name. The bit must never be given to another rule."""
    bit: int
    name: str
    fails: Callable[[dict[str, int]], bool]


@dataclass(frozen=True)
class Policy:
    """Rules that count, by name; a document is kept if at most ``allowed`` of them fail."""
    version: str
    rules: tuple[str, ...]
    allowed: int = 0


RULES = (
    Rule(0, "short", lambda m: m["n_words"] < 50),
    Rule(1, "repeated_windows", lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
    Rule(2, "symbols", lambda m: 10 * m["n_symbols"] > m["n_words"]),
    Rule(3, "repeated_lines", lambda m: 2 * m["n_dup_lines"] > m["n_lines"]),
    Rule(4, "shouting", lambda m: 2 * m["n_upper_words"] > m["n_words"]),
    Rule(5, "word_length", lambda m: not 2 * m["n_words"] <= m["word_chars"] <= 15 * m["n_words"]),
    Rule(6, "long", lambda m: m["n_words"] > 100_000),
    Rule(7, "some_repeated_lines", lambda m: 10 * m["n_dup_lines"] > 3 * m["n_lines"]),
    Rule(8, "some_repeated_windows", lambda m: 100 * m["n_repeat_words"] > 20 * m["n_words"]),
)
BASE = Policy("base", ("short", "repeated_windows"))
#: In use: only rules that a clean text does not fail.
PRODUCTION = Policy("2", ("short", "repeated_windows", "symbols", "repeated_lines", "shouting", "word_length"))
#: For ablations: the tighter limits of the same kind count too.
STRICT = Policy("2-strict", (*PRODUCTION.rules, "long", "some_repeated_lines", "some_repeated_windows"))


def measure(text: bytes | None) -> dict[str, int]:
    """Measurements of one whole text (null: as empty). Words end at the six ASCII white-space bytes."""
    text = text or b""
    words = text.split()
    n = len(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    return {
        "n_words": n, "word_chars": len(b"".join(words).decode()),
        "n_symbols": sum(text.count(c) for c in SYMBOLS),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": repeat_words(words),
        "n_lines": len(lines), "n_upper_words": sum(map(bytes.isupper, words)),
    }


def repeat_words(words: list[bytes], width: int = 3) -> int:
    """Words in windows of ``width`` that stand twice or more in the text, the first one included."""
    windows = list(zip(*(words[i:] for i in range(width))))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered, end = 0, 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered += i + width - max(end, i)
            end = i + width
    return covered


def ledger(df: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, out: str = "ledger") -> DataFrame:
    """``df`` and a struct ``out`` of measurements and ``failed``, the bits of the failed rules.

    Null and empty texts have no words and fail the rules that ask for some.
    Repeated rows are judged each; an empty table gives an empty table.
    """
    def make(texts: list) -> dict[str, list]:
        got = [measure(t) for t in texts]
        cols = {m: [g[m] for g in got] for m in MEASURES}
        return cols | {"failed": [sum(1 << r.bit for r in rules if r.fails(g)) for g in got]}

    return add_struct(df, text_col, out, LEDGER, make)


def mask_of(policy: Policy, rules: tuple[Rule, ...] = RULES) -> int:
    bits = {r.name: r.bit for r in rules}
    return sum(1 << bits[n] for n in policy.rules)


def fails(failed: Column, policy: Policy, rules: tuple[Rule, ...] = RULES) -> Column:
    """True where more of the policy's rules fail than it allows."""
    return F.bit_count(failed.bitwiseAND(F.lit(mask_of(policy, rules)))) > policy.allowed


def ablations(df: DataFrame, policy: Policy, failed: str = "ledger.failed", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """For each rule of the policy: documents that fail it, and those that it alone rejects.

    One pass over the stored bits: rows collapse to distinct masks (2 to the
    number of rules at most) before anything is unfolded.
    """
    masks = df.groupBy(F.col(failed).bitwiseAND(F.lit(mask_of(policy, rules))).alias("m")).agg(F.count("*").alias("n"))
    bits = {r.name: r.bit for r in rules}
    named = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(1 << bits[n]).cast("long").alias("bit")) for n in policy.rules]))
    rest = F.col("m").bitwiseAND(F.bitwise_not(F.col("r.bit")))
    hit, now, then = F.col("m").bitwiseAND(F.col("r.bit")) != 0, F.bit_count("m") > policy.allowed, F.bit_count(rest) > policy.allowed
    return (masks.withColumn("r", named).groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
                 F.sum(F.when(now & ~then, F.col("n")).otherwise(0)).alias("n_only_by_it"))
            .withColumn("policy", F.lit(policy.version)))
