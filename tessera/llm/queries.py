"""One query for each operator, over its whole table, and the SQL that says the same where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (conversation_repair, decontaminate, duck_bpe, html_mincut, importance_sample, license_index, quality, secret_scan,
                         sharding, simhash, token_files, url_vocab, window_dedup)
from tessera.llm.common import table

URL_RULES = [
    url_vocab.Rule("allow", "org", "/"), url_vocab.Rule("block", "example.org", "/es/"),
    url_vocab.Rule("block", "example.org", "/en/1"), url_vocab.Rule("allow", "com", "/fr/"),
    url_vocab.Rule("block", "com", "/de/"),
]


def op1_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = sharding.shard_by_bytes(table(spark, sf_dir, "documents"), n_shards=40)
    return got.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op2_mincut_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_mincut.extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"]).select("page_id", "url", "main.*")


def op3_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = quality.ledger(table(spark, sf_dir, "documents"))
    failed = F.col("ledger.failed")
    base = quality.fails(failed, quality.BASE)
    return got.select("doc_id", *[f"ledger.{m}" for m in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                      base.alias("base_failed"), (~base & ~quality.fails(failed, quality.PRODUCTION)).alias("kept"),
                      failed.alias("failed_rules"))


def op4_simhash_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_distance=2)
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = secret_scan.scan(table(spark, sf_dir, "documents"), owner_col="source", repo_col="lang")
    return got.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"),
                      "spans", "n_live", "n_example", "n_spread")


def op6_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_index.scan_licenses(table(spark, sf_dir, "documents")).select("doc_id", "license.*")


def op7_simple8b_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    manifest = token_files.write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.read_ids(manifest)


def op8_duckdb_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    got = duck_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                              public_tokenizers.PATTERN, keep=["doc_id"])
    return got.select("doc_id", "bpe.*")


def op9_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), **decontaminate.WHOLE)
    return got.drop("text_hash").distinct()


def op10_url_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = url_vocab.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)
    return got.select("page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict",
                      F.concat_ws(",", "judged.strict").alias("strict_terms"), F.concat_ws(",", "judged.soft").alias("soft_terms"))


def op11_glr_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    found = conversation_repair.summaries(conversation_repair.repair(conversation_repair.damage(rows)))
    every = rows.select("conv_id").distinct()
    none = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit("").cast("binary"), 256)}
    got = every.join(found.withColumnRenamed("conv_id", "_conv"), F.col("conv_id").cast("string").eqNullSafe(F.col("_conv")), "left")
    return got.select("conv_id", *[F.coalesce(F.col(c), none.get(c, F.lit(0).cast("long"))).alias(c) for c in found.columns if c != "conv_id"])


def op12_superkmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = window_dedup.remove_repeats(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return got.select("doc_id", "repeats.n_words", "repeats.n_removed", F.sha2(F.col("repeats.kept").cast("binary"), 256).alias("kept_sha256"))


def op13_radix_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = importance_sample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return got.select("doc_id", "sample.*")


QUERIES = {f.__name__: f for f in (op1_histogram_shards, op2_mincut_text, op3_quality_ledger, op4_simhash_index, op5_secret_ownership, op6_license_index,
                                  op7_simple8b_ids, op8_duckdb_bpe, op9_template_leaks, op10_url_vocabulary, op11_glr_repair,
                                  op12_superkmer_dedup, op13_radix_resample)}

_WORD = r"[^\x20\x09-\x0D]+"


def _op3_sql() -> str:
    fail = lambda name: f"(failed & {1 << next(r.bit for r in quality.RULES if r.name == name)}) <> 0"
    base, production = (" OR ".join(map(fail, p.rules)) for p in (quality.BASE, quality.PRODUCTION))
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '{_WORD}') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS ls FROM t),
g AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM w, unnest(range(1, len(ws) - 1)) AS u(i)),
d AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
c AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM d) GROUP BY r),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, len(ls) AS n_lines,
             len(list_filter(ws, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS n_upper_words
      FROM w LEFT JOIN c ON w.r = c.r),
f AS (SELECT *, CAST((n_words < 50)::INT + (100 * n_repeat_words > 50 * n_words)::INT * 2 + (10 * n_symbols > n_words)::INT * 4
                     + (2 * n_dup_lines > n_lines)::INT * 8 + (2 * n_upper_words > n_words)::INT * 16
                     + (NOT (2 * n_words <= word_chars AND word_chars <= 15 * n_words))::INT * 32 + (n_words > 100000)::INT * 64
                     + (10 * n_dup_lines > 3 * n_lines)::INT * 128 + (100 * n_repeat_words > 20 * n_words)::INT * 256 AS BIGINT) AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({base}) AS base_failed, NOT ({production}) AS kept, failed AS failed_rules
FROM f"""


def _op10_sql() -> str:
    def hits(terms):
        return f"list_filter({list(terms)}, lambda t: regexp_matches(low, '(^|[^a-z0-9])' || t || '([^a-z0-9]|$)'))"

    rules = sorted(URL_RULES, key=lambda r: -len(r.name))
    fits = [f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in rules]
    case = lambda value: "CASE " + " ".join(f"WHEN {f} THEN '{value(r)}'" for f, r in zip(fits, rules)) + " END"
    return f"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS p FROM pages),
h AS (SELECT page_id, lower(url) AS low, CASE WHEN p > 0 THEN translate(regexp_extract(substr(url, p + 3), '^([^/?#]*)', 1),
             '{url_vocab.UPPER}', '{url_vocab.LOWER}') ELSE '' END AS host,
             CASE WHEN p > 0 THEN regexp_extract(substr(url, p + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM u),
x AS (SELECT *, {hits(sorted(url_vocab.STRICT))} AS strict, {hits(sorted(set(url_vocab.SOFT) - set(url_vocab.STRICT)))} AS soft FROM h)
SELECT page_id, host, path, {case(lambda r: r.name)} AS rule,
       coalesce({case(lambda r: r.verdict)}, CASE WHEN len(strict) > 0 OR len(soft) > 1 THEN 'block' ELSE 'allow' END) AS verdict,
       array_to_string(strict, ',') AS strict_terms, array_to_string(soft, ',') AS soft_terms FROM x"""


#: Fingerprints, crc32, spans, minimum cuts and token ids have no DuckDB form: those queries are tested against brute force.
ORACLES = {"op3_quality_ledger": _op3_sql(), "op10_url_vocabulary": _op10_sql()}
