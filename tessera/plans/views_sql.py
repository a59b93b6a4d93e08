"""The fixture views of ``tessera.sources.fixtures`` written as plain SQL
(DuckDB dialect), for the oracle queries."""

VIEWS = {
    "tab": """
SELECT o.o_orderkey,
       CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE o.o_totalprice END AS o_totalprice,
       CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE c.c_acctbal END AS c_acctbal,
       CASE WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE o.o_orderstatus END AS o_orderstatus,
       c.c_mktsegment,
       CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) - 1 END AS y
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "tab_new": """
SELECT o.o_orderkey,
       CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE o.o_totalprice END AS o_totalprice,
       o.o_custkey, c.c_mktsegment
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "subj": """
SELECT CAST(c_custkey AS VARCHAR) AS id,
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
       CAST(c_nationkey AS DOUBLE) AS c_nationkey,
       CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
       CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_nationkey % 4 END AS sii
FROM customer""",
    "series": """
SELECT CAST(user_id AS VARCHAR) AS id, ts, event_id,
       CASE WHEN event_id % 7 < 2 THEN NULL ELSE value END AS value,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
       event_type
FROM events""",
    "doc_lab": """
SELECT d.doc_id, d.lang, d.source, CAST(d.n_chars AS DOUBLE) AS n_chars, l.quality
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "vec": """
SELECT vec_id, CAST(embedding AS DOUBLE[]) AS features, label FROM embeddings""",
    "pred": """
SELECT y, CASE WHEN s % 4 = 0 THEN (y + 1) % 3 WHEN s % 9 = 0 THEN (y + 2) % 3 ELSE y END AS yhat,
       partkey, batch
FROM (SELECT CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS y,
             l_orderkey + l_linenumber AS s, l_partkey AS partkey, l_orderkey % 97 AS batch
      FROM lineitem)""",
}

ORDER = ["tab", "tab_new", "subj", "series", "doc_lab", "vec", "pred"]


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with CTEs for the named views."""
    ctes = [f"{n} AS ({VIEWS[n]})" for n in ORDER if n in names]
    if not ctes:
        return body
    body = body.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body
