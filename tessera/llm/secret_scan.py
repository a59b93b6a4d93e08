"""Secret scan with corpus-wide ownership frequency.

Every candidate value is hashed; over the whole corpus each hash is counted by
distinct repositories and owners. A value that many owners have, or that a
few owners have in many repositories, is a widely copied example; one that few
owners have and that looks random is live, in however many repositories of one
owner it stands.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import add_struct, free_name, materialize

# Kinds in order, the base ones first; patterns of well-known token formats.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # runs of [0-9a-f]+ with 32 or more
ADDED = {
    "private_key": ("PRIVATE KEY-----", re.compile(r"(?s)-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?:((?:(?!-----BEGIN ).)*?)-----END [A-Z ]{0,40}PRIVATE KEY-----)?")),
    "jwt": ("eyJ", re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
    "github": ("gh", re.compile(r"\bgh[pousr]_[A-Za-z0-9]{36,}")),
    "slack": ("xox", re.compile(r"\bxox[abprs]-[A-Za-z0-9-]{10,}")),
    "google": ("AIza", re.compile(r"AIza[0-9A-Za-z_-]{35}")),
    "stripe": ("k_live_", re.compile(r"\b[sr]k_live_[0-9A-Za-z]{16,}")),
    "basic_auth": ("://", re.compile(r"://[A-Za-z0-9_.-]{1,64}:[^\s:@/]{8,64}@")),
}
KINDS = ("assign", "access", "hex", *ADDED)
WORDS_BEFORE = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
PLACEHOLDERS = re.compile(r"(?i)example|sample|dummy|change_?me|placeholder|your|xxxx|1234567|abcdef")
_RUNS = bytes(120 if chr(i) in "0123456789abcdef" else 46 for i in range(256))  # x and .

VALUE = T.StructType([T.StructField("hash", T.BinaryType()), T.StructField("start", T.IntegerType()),
                      T.StructField("end", T.IntegerType()), T.StructField("strong", T.BooleanType())])
SCAN = T.StructType([T.StructField("n_assign", T.LongType()), T.StructField("n_access", T.LongType()),
                     T.StructField("n_hex", T.LongType()), T.StructField("base", T.StringType()),
                     T.StructField("spans", T.StringType()), T.StructField("values", T.ArrayType(VALUE))])


def looks_random(value: str, least: float = 3.0) -> bool:
    """No placeholder word, and at least ``least`` bits of entropy a character; of fewer than 12 the same share of what they can have."""
    n = len(value)
    if n < 2 or PLACEHOLDERS.search(value):
        return False
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) >= least * min(1.0, math.log2(n) / math.log2(12))


def scan_text(raw: bytes | None) -> tuple[list, list, list]:
    """Base spans, all spans, values of one whole text: (start, kind number, end) in order, code points.

    A value is (hash, start, end, looks random): what is counted over the corpus.
    """
    if not raw:
        return [], [], []
    low = raw.lower()
    assign = any(w in low for w in WORDS_BEFORE)
    access, runs = b"AKIA" in raw, b"x" * 32 in raw.translate(_RUNS)
    added = [(k, p) for k, (has, p) in ADDED.items() if has.encode() in raw]
    if not (assign or access or runs or added):
        return [], [], []
    text, base, more, values = raw.decode(), [], [], []

    def value(start: int, end: int, said: str | None = None) -> None:
        v = text[start:end] if said is None else said
        values.append({"hash": hashlib.blake2b(v.encode(), digest_size=16).digest(), "start": start, "end": end, "strong": looks_random(v)})

    if assign:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 8:
                base.append((m.start(), 0, m.end()))
                value(*m.span(2))
    for on, kind, pattern, least in ((access, 1, ACCESS, 16), (runs, 2, HEX, 32)):
        for m in pattern.finditer(text) if on else ():
            if m.end() - m.start() >= least:
                base.append((m.start(), kind, m.end()))
                value(*m.span())
    for kind, pattern in added:
        for m in pattern.finditer(text):
            more.append((m.start(), KINDS.index(kind), m.end()))
            # a key is told by its body, however its lines are broken
            value(*m.span(), "".join(m[1].split()) if kind == "private_key" and m[1] else None)
    return sorted(base), sorted(base + more), values


def _said(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find(df: DataFrame, text_col: str = "text", out: str = "scan") -> DataFrame:
    """``df`` and a struct ``out``: counts of the base kinds, spans, values. Null and empty texts have none."""
    def make(texts: list) -> dict[str, list]:
        got = [scan_text(t) for t in texts]
        count = lambda k: [sum(x[1] == k for x in g[0]) for g in got]
        return {"n_assign": count(0), "n_access": count(1), "n_hex": count(2), "base": [_said(g[0]) for g in got],
                "spans": [_said(g[1]) for g in got], "values": [g[2] for g in got]}

    return add_struct(df, text_col, out, SCAN, make)


def ownership(values: DataFrame) -> DataFrame:
    """hash, n_owners, n_repos from (hash, owner, repo): distinct triples first, so a hot value costs a row an owner and repository.

    A repository is told by its owner and name. A null owner or name counts as one of its own.
    """
    triples = values.groupBy("hash", "owner", "repo").agg(F.lit(1).alias("one"))
    owners = triples.groupBy("hash", "owner").agg(F.count("*").alias("repos"))
    return owners.groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"))


def judge(found: DataFrame, key: str, scan: str, owner: str, repo: str, max_owners: int, max_repos: int) -> DataFrame:
    """key, n_live, n_example, n_spread, live (spans): a row for each ``key`` of ``found`` that has values.

    Examples are values of more than ``max_owners`` owners, and of two owners or
    more in more than ``max_repos`` repositories. ``n_spread`` counts live values
    that one owner has in several repositories.

    ``found`` must be a written table. Both sides of the join by hash are plain
    tables, so that adaptive execution can split a value that very many rows have.
    """
    values = (found.where(F.size(f"{scan}.values") > 0)
              .select(key, F.col(f"`{owner}`").cast("string").alias("owner"), F.col(f"`{repo}`").cast("string").alias("repo"),
                      F.explode(f"{scan}.values").alias("v")).select(key, "owner", "repo", "v.*"))
    owned = materialize(ownership(values.select("hash", "owner", "repo")), "ownership")
    example = (F.col("n_owners") > max_owners) | ((F.col("n_owners") > 1) & (F.col("n_repos") > max_repos))
    live = ~example & F.col("strong")
    return (values.drop("owner", "repo").join(owned, "hash").groupBy(key)
            .agg(F.sum(live.cast("long")).alias("n_live"), F.sum(example.cast("long")).alias("n_example"),
                 F.sum((live & (F.col("n_owners") == 1) & (F.col("n_repos") > 1)).cast("long")).alias("n_spread"),
                 F.collect_list(F.when(live, F.struct("start", "end"))).alias("live")))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str = "lang",
         max_owners: int = 2, max_repos: int = 8) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base, spans, n_live, n_example, n_spread: a row for each row of ``df``.

    A value that more than ``max_owners`` distinct owners have, or several owners
    in more than ``max_repos`` repositories, is an example; of the others, those
    that look random are live (``n_spread``: those in several repositories of one owner). Repeated rows are returned
    each, an empty table gives an empty one.
    """
    key = "_row"
    narrow = find(df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                            F.col(f"`{owner_col}`").alias("owner"), F.col(f"`{repo_col}`").alias("repo")), "text")
    found = materialize(narrow.drop("text").withColumn(key, F.monotonically_increasing_id()), "secrets")
    judged = judge(found, key, "scan", "owner", "repo", max_owners, max_repos).drop("live")
    zero = F.lit(0).cast("long")
    return found.join(judged, key, "left").select(
        "doc_id", *[f"scan.{c}" for c in ("n_assign", "n_access", "n_hex", "base", "spans")],
        F.coalesce("n_live", zero).alias("n_live"), F.coalesce("n_example", zero).alias("n_example"), F.coalesce("n_spread", zero).alias("n_spread"))


def redact(df: DataFrame, text_col: str = "text", owner_col: str = "source", repo_col: str = "lang", max_owners: int = 2,
           mark: str = "[SECRET]", length_col: str | None = None, max_repos: int = 8) -> DataFrame:
    """``df`` with every live value replaced by ``mark``; examples and all else stay, and so does every row.

    Rows without a value pass straight through; only the others are written and
    joined. ``length_col``, if there, is set to the new length of a changed text.
    """
    s, key = free_name(df, "_scan"), free_name(df, "_row")
    tagged = find(df, text_col, s)
    plain = tagged.where(F.size(f"{s}.values") == 0).drop(s)
    held = materialize(tagged.where(F.size(f"{s}.values") > 0).withColumn(key, F.monotonically_increasing_id()), "with-secrets")
    live = judge(held, key, s, owner_col, repo_col, max_owners, max_repos).where(F.size("live") > 0).select(key, F.col("live").alias(s))

    @F.udf(returnType="string", useArrow=True)
    def cut(text: str | None, spans: list | None) -> str | None:
        if text is None or not spans:  # both arms of a conditional are evaluated for a Python function
            return text
        parts, end = [], 0
        for a, b in sorted((x["start"], x["end"]) for x in spans):
            if a >= end:
                parts += [text[end:a], mark]
            end = max(end, b)
        return "".join([*parts, text[end:]])

    joined = held.drop(s).join(live, key, "left")
    done = joined.withColumn(text_col, cut(F.col(f"`{text_col}`"), F.col(s)))
    if length_col in df.columns:
        kind = df.schema[length_col].dataType
        done = done.withColumn(length_col, F.when(F.col(s).isNotNull(), F.length(f"`{text_col}`").cast(kind)).otherwise(F.col(f"`{length_col}`")))
    cols = [f"`{c}`" for c in df.columns]
    return plain.select(*cols).union(done.select(*cols))
