"""DuckDB oracle SQL for the registered queries (same names, same columns)."""

from __future__ import annotations

from tessera.plans.views_sql import with_views

ORACLES: dict = {}


def mode_sql(col: str, src: str) -> str:
    """Most frequent non-null value, ties → smallest."""
    return (f"(SELECT v FROM (SELECT {col} AS v, count(*) AS n FROM {src} WHERE {col} IS NOT NULL "
            f"GROUP BY 1) ORDER BY n DESC, v LIMIT 1)")


# ------------------------------------------------ neighbour family
# Brute force over all recipient × donor pairs: fine for DuckDB at the
# check's scale; the Spark side uses the grid-verified search.
def _knn_col(t, o):
    return f"""r_{t} AS (SELECT o_orderkey, {o} FROM tt WHERE {t} IS NULL AND {o} IS NOT NULL),
c_{t} AS (SELECT r.o_orderkey AS rk, d.o_orderkey AS dk, d.{t} AS v,
                 sqrt(2.0 / 1.0 * (0.0 + (r.{o} - d.{o}) * (r.{o} - d.{o}))) AS dist
          FROM r_{t} r JOIN tt d ON d.{t} IS NOT NULL AND d.{o} IS NOT NULL),
k_{t} AS (SELECT rk, avg(v) AS imp FROM (SELECT *, row_number() OVER (PARTITION BY rk ORDER BY dist, dk) AS rn
          FROM c_{t}) WHERE rn <= 5 GROUP BY rk)"""



def tab_prep_sql(agg: str, new: bool = False, rnd: bool = True, l_sql: str | None = None,
                 pre: str = "", app_src: str | None = None) -> str:
    """Fit on labelled ``tab`` rows; emit features of those rows or, with
    ``new``, of ``tab_new`` aligned to the training schema."""
    num = ["o_totalprice", "c_acctbal"]
    cat = ["o_orderstatus", "c_mktsegment"]
    knn = agg == "knn"
    fills = ", ".join([f"{'avg' if knn else agg}({c}) AS f_{c}" for c in num] +
                      [f"{mode_sql(c, 'l')} AS f_{c}" for c in cat])
    if knn:   # kNN over the labelled rows (donors = the same rows), mean as fallback
        imp = ", ".join([f"coalesce(l.o_totalprice, k1.imp, f_o_totalprice) AS o_totalprice",
                         f"coalesce(l.c_acctbal, k2.imp, f_c_acctbal) AS c_acctbal"] +
                        [f"coalesce(l.{c}, f_{c}) AS {c}" for c in cat])
    else:
        imp = ", ".join([f"coalesce({c}, f_{c}) AS {c}" for c in num + cat])
    sc = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in num)
    cats = ",\n".join(f"cat_{c} AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS r "
                      f"FROM (SELECT DISTINCT {c} AS v FROM imp))" for c in cat)
    if new:
        app = ("app AS (SELECT n.o_orderkey, coalesce(n.o_totalprice, f_o_totalprice) AS o_totalprice, "
               "f_c_acctbal AS c_acctbal, '0' AS o_orderstatus, coalesce(n.c_mktsegment, f_c_mktsegment) AS c_mktsegment "
               "FROM tab_new n, fill)")
    elif app_src:
        app = (f"app AS (SELECT a.o_orderkey, {', '.join(f'coalesce(a.{c}, f_{c}) AS {c}' for c in num + cat)} "
               f"FROM {app_src} a, fill)")
    else:
        app = "app AS (SELECT * FROM imp)"
    R, R6 = ("round", ", 6") if rnd else ("", "")
    parts = []
    for i, c in enumerate(num):
        parts.append(f"SELECT o_orderkey, CAST({i} AS INTEGER) AS fi, '{c}' AS feature, "
                     f"{R}(({c} - m_{c}) / (CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 1 ELSE s_{c} END){R6}) AS value "
                     f"FROM app, sc")
    off = str(len(num))
    for c in cat:
        parts.append(f"SELECT o_orderkey, CAST({off} + x.r AS INTEGER) AS fi, '{c}_' || x.v AS feature, "
                     f"{R}(CASE WHEN app.{c} = x.v THEN 1.0 ELSE 0.0 END{R6}) AS value FROM app, cat_{c} x")
        off += f" + (SELECT count(*) FROM cat_{c})"
    knn_ctes = ("tt AS (SELECT o_orderkey, o_totalprice, c_acctbal FROM l),\n"
                + _knn_col("o_totalprice", "c_acctbal") + ",\n" + _knn_col("c_acctbal", "o_totalprice") + ",\n"
                if knn else "")
    knn_join = (" LEFT JOIN k_o_totalprice k1 ON l.o_orderkey = k1.rk LEFT JOIN k_c_acctbal k2 ON l.o_orderkey = k2.rk"
                if knn else "")
    body = f"""WITH {pre}l AS ({l_sql or "SELECT * FROM tab WHERE y IS NOT NULL"}),
fill AS (SELECT {fills} FROM l),
{knn_ctes}imp AS (SELECT l.o_orderkey, {imp} FROM l{knn_join}, fill),
sc AS (SELECT {sc} FROM imp),
{cats},
{app}
""" + "\nUNION ALL\n".join(parts)
    return with_views(body, "tab", "tab_new") if new else with_views(body, "tab")


ORACLES["d5_prep_train_median"] = tab_prep_sql("median")
ORACLES["c2_prep_train_mean"] = tab_prep_sql("avg")


# ---------------------------------------------------------------- series (H)
def fill_sql(bfill=True, zero=True, every=None, tail=None, ffill=True) -> str:
    def fill(c):
        parts = [f"{c}_ff"]
        if bfill:
            parts.append(f"{c}_hd")
        if zero:
            parts.append("0")
        return f"coalesce({', '.join(parts)})" if len(parts) > 1 else parts[0]
    where = ["TRUE"]
    if every:
        where.append(f"(rn - 1) % {every} = 0")
        pos, kept = f"(rn - 1) // {every}", f"CAST(ceil(cnt / {every}) AS BIGINT)"
    else:
        pos, kept = "rn - 1", "cnt"
    if tail is not None:
        where.append(f"{pos} >= {kept} - {tail}")
    cols = ["value", "k"]
    wins = ",\n".join(
        f"last_value({c} IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}_ff, "
        f"first_value({c} IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS {c}_hd"
        for c in cols)
    return f"""WITH s AS (
  SELECT id, ts, event_id, row_number() OVER w AS rn, count(*) OVER (PARTITION BY id) AS cnt, {wins}
  FROM series WINDOW w AS (PARTITION BY id ORDER BY ts, event_id)),
f AS (SELECT id, ts, event_id, rn, cnt, {fill('value')} AS value, {fill('k')} AS k FROM s WHERE {' AND '.join(where)})"""


def _ser_sql(**kw):
    return with_views(fill_sql(**kw) + "\nSELECT id, event_id, round(value, 6) AS value, round(k, 6) AS k FROM f", "series")


ORACLES["h1_ffill"] = _ser_sql(bfill=False, zero=False)
ORACLES["h2_fill_chain"] = _ser_sql()
ORACLES["h3_ffill_zero"] = _ser_sql(bfill=False)
ORACLES["h4_downsample"] = _ser_sql(every=10)
ORACLES["h5_tail"] = _ser_sql(every=10, tail=5)
ORACLES["h2_fill_keep_columns"] = with_views(fill_sql() + """
SELECT f.id, f.event_id, s.event_type, round(f.value, 6) AS value, round(f.k, 6) AS k
FROM f JOIN series s ON f.id = s.id AND f.ts = s.ts AND f.event_id = s.event_id""", "series")
ORACLES["h4_downsample_rows"] = with_views("""
SELECT id, event_id, event_type FROM series
QUALIFY (row_number() OVER (PARTITION BY id ORDER BY ts, event_id) - 1) % 10 = 0""", "series")
ORACLES["h5_tail_rows"] = with_views("""
SELECT id, event_id, event_type FROM series
QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts DESC, event_id DESC) <= 5""", "series")

SEQ_CTE = fill_sql(every=10, tail=5) + """,
q AS (SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY ts, event_id) - 1 AS INTEGER) AS t,
             CAST(event_id AS DOUBLE) AS x0, value AS x1, k AS x2 FROM f)"""

ORACLES["h7_sequences"] = with_views(SEQ_CTE + """
SELECT id, t, CAST(0 AS INTEGER) AS f, round(x0, 6) AS value FROM q
UNION ALL SELECT id, t, CAST(1 AS INTEGER), round(x1, 6) FROM q
UNION ALL SELECT id, t, CAST(2 AS INTEGER), round(x2, 6) FROM q""", "series")

_BATCH = """,
n AS (SELECT id, count(*) AS n_steps, sum(x0 + x1 + x2) AS tot FROM q GROUP BY id),
b AS (SELECT id, n_steps, tot, CAST((row_number() OVER (ORDER BY {order}) - 1) // 8 AS BIGINT) AS batch_id FROM n)
SELECT id, batch_id, {cols} FROM b"""
ORACLES["b9_pad_batches"] = with_views(SEQ_CTE + _BATCH.format(
    order="substr(md5('42:' || id), 1, 15), id",
    cols="CAST(n_steps AS INTEGER) AS n_steps, CAST(max(n_steps) OVER (PARTITION BY batch_id) AS INTEGER) AS padded_steps, "
         "round(tot, 6) AS pad_sum"), "series")
ORACLES["b9_batches_in_order"] = with_views(SEQ_CTE + _BATCH.format(
    order="id", cols="CAST(max(n_steps) OVER (PARTITION BY batch_id) AS INTEGER) AS padded_steps"), "series")


# ------------------------------------------------------- balance & split (G)
DOCS = "docs AS (SELECT * FROM doc_lab WHERE quality IS NOT NULL)"


def H60(expr: str) -> str:
    return f"('0x' || substr(md5({expr}), 1, 15))::UBIGINT"


def ranked_sql(src: str, key: str, group: str | None, seed: str = "42") -> str:
    part = f"PARTITION BY {group} " if group else ""
    return (f"SELECT *, row_number() OVER ({part}ORDER BY substr(md5('{seed}:' || {key}), 1, 15), {key}) AS rk "
            f"FROM {src}")


ORACLES["b1_drop_missing_target"] = with_views(f"WITH {DOCS} SELECT doc_id, quality FROM docs", "doc_lab")

SPLIT_COUNTS = """cnt AS (SELECT {lab} AS c, count(*) AS n_c FROM {src} GROUP BY 1),
tot AS (SELECT sum(n_c) AS n, CAST(ceil({ts} * sum(n_c)) AS BIGINT) AS n_test FROM cnt),
al AS (SELECT c, n_c, (n - n_test) * n_c // n AS base, ((n - n_test) * n_c) % n AS rem, n, n_test FROM cnt, tot),
al2 AS (SELECT *, row_number() OVER (ORDER BY rem DESC, c) AS rr,
               (n - n_test) - sum(base) OVER () AS extra FROM al),
tc AS (SELECT c, n_c - (base + CASE WHEN rr <= extra THEN 1 ELSE 0 END) AS t FROM al2)"""


def strat_sql(src, lab, key, ts="0.2"):
    return (SPLIT_COUNTS.format(lab=lab, src=src, ts=ts) + f""",
rk AS ({ranked_sql(src, key, lab)}),
sp AS (SELECT rk.*, CASE WHEN rk.rk <= tc.t THEN 'val' ELSE 'train' END AS split
       FROM rk JOIN tc ON rk.{lab} = tc.c)""")


ORACLES["b11_class_counts"] = with_views(f"WITH {DOCS}, " + strat_sql("docs", "quality", "doc_id") +
                                         " SELECT split, quality, count(*) AS n FROM sp GROUP BY 1, 2", "doc_lab")
ORACLES["b12_num_classes"] = with_views("SELECT count(DISTINCT y) AS num_classes FROM tab", "tab")
ORACLES["g1_class_weights"] = with_views(
    f"WITH {DOCS}, cnt AS (SELECT quality, count(*) AS n_c FROM docs GROUP BY 1) "
    "SELECT quality, n_c, round(sum(n_c) OVER () / (count(*) OVER () * n_c), 6) AS weight FROM cnt", "doc_lab")
ORACLES["g2_random_over"] = with_views(f"""WITH {DOCS},
cnt AS (SELECT quality, count(*) AS n_c FROM docs GROUP BY 1),
mx AS (SELECT quality, n_c, max(n_c) OVER () - n_c AS d FROM cnt),
dr AS (SELECT quality, n_c, unnest(range(d)) AS i FROM mx WHERE d > 0),
dj AS (SELECT quality, i, {H60("'42:' || quality || ':' || i")} % n_c + 1 AS rk FROM dr),
rk AS ({ranked_sql("docs", "doc_id", "quality")})
SELECT doc_id, quality, CAST(0 AS BIGINT) AS copy FROM docs
UNION ALL
SELECT rk.doc_id, rk.quality, CAST(dj.i + 1 AS BIGINT) FROM dj JOIN rk ON dj.quality = rk.quality AND dj.rk = rk.rk""",
                                       "doc_lab")
ORACLES["g3_random_under"] = with_views(f"""WITH {DOCS},
cnt AS (SELECT quality, count(*) AS n_c FROM docs GROUP BY 1),
rk AS ({ranked_sql("docs", "doc_id", "quality")})
SELECT doc_id, quality FROM rk WHERE rk <= (SELECT min(n_c) FROM cnt)""", "doc_lab")
ORACLES["g6_stratified_split"] = with_views(
    "WITH t AS (SELECT o_orderkey, y FROM tab WHERE y IS NOT NULL), " + strat_sql("t", "y", "o_orderkey") +
    " SELECT o_orderkey, y, split FROM sp", "tab")
ORACLES["g7_split_val"] = with_views(f"WITH {DOCS}, " + strat_sql("docs", "quality", "doc_id") +
                                     " SELECT doc_id, quality FROM sp WHERE split = 'val'", "doc_lab")
ORACLES["g8_random_split"] = f"""WITH rk AS ({ranked_sql("orders", "o_orderkey", None)})
SELECT o_orderkey, CASE WHEN rk <= floor(0.8 * (SELECT count(*) FROM orders)) THEN 'train' ELSE 'val' END AS split FROM rk"""


# ------------------------------------------------------------- metrics (M)
PRED_L = """pl AS (SELECT y, yhat, batch,
  CASE WHEN yhat = 0 THEN 2.0 ELSE 0.5 * ((partkey + 0) % 3) END AS l0,
  CASE WHEN yhat = 1 THEN 2.0 ELSE 0.5 * ((partkey + 1) % 3) END AS l1,
  CASE WHEN yhat = 2 THEN 2.0 ELSE 0.5 * ((partkey + 2) % 3) END AS l2 FROM pred),
pm AS (SELECT *, greatest(l0, l1, l2) AS m FROM pl),
ls AS (SELECT y, yhat, batch, -((CASE y WHEN 0 THEN l0 WHEN 1 THEN l1 ELSE l2 END) - m
        - ln(exp(l0 - m) + exp(l1 - m) + exp(l2 - m))) AS loss FROM pm)"""

SCORES = """conf AS (SELECT y, yhat, count(*) AS n FROM pred GROUP BY 1, 2),
sup AS (SELECT y AS c, sum(n) AS support, sum(CASE WHEN y = yhat THEN n ELSE 0 END) AS tp FROM conf GROUP BY 1),
prd AS (SELECT yhat AS c, sum(n) AS predicted FROM conf GROUP BY 1),
pc AS (SELECT coalesce(sup.c, prd.c) AS c, coalesce(support, 0) AS support, coalesce(predicted, 0) AS predicted,
              coalesce(tp, 0) AS tp FROM sup FULL JOIN prd ON sup.c = prd.c),
pr AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS p,
              CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS r FROM pc),
pf AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f1 FROM pr),
sc AS (SELECT round(sum(tp) / sum(support), 6) AS accuracy,
              round(avg(CASE WHEN support > 0 THEN r END), 6) AS balanced_accuracy,
              round(sum(support * p) / sum(support), 6) AS precision,
              round(sum(support * r) / sum(support), 6) AS recall,
              round(sum(support * f1) / sum(support), 6) AS f1 FROM pf)"""

ORACLES["m1_confusion"] = with_views("SELECT y, yhat, count(*) AS n FROM pred GROUP BY 1, 2", "pred")
ORACLES["m2_m6_scores"] = with_views(f"WITH {SCORES} SELECT * FROM sc", "pred")
ORACLES["m7_cross_entropy"] = with_views(f"WITH {PRED_L} SELECT round(avg(loss), 6) AS loss FROM ls", "pred")
ORACLES["m7_weighted_cross_entropy"] = with_views(f"""WITH {PRED_L},
cnt AS (SELECT y, count(*) AS n_c FROM pred GROUP BY 1),
w AS (SELECT y, sum(n_c) OVER () / (count(*) OVER () * n_c) AS weight FROM cnt)
SELECT round(sum(weight * loss) / sum(weight), 6) AS loss FROM ls JOIN w USING (y)""", "pred")
ORACLES["m8_batch_mean_loss"] = with_views(
    f"WITH {PRED_L} SELECT round(avg(bl), 6) AS loss FROM (SELECT batch, avg(loss) AS bl FROM ls GROUP BY 1)", "pred")
ORACLES["m9_report"] = with_views(f"""WITH {PRED_L}, {SCORES},
lo AS (SELECT round(avg(bl), 6) AS loss FROM (SELECT batch, avg(loss) AS bl FROM ls GROUP BY 1))
SELECT * FROM sc, lo""", "pred")


# ------------------------------------------------- subjects & samples (B, D6)
SUBJ_FIT = """L AS (SELECT * FROM subj WHERE sii IS NOT NULL),
fl AS (SELECT avg(c_acctbal) AS fa, avg(c_nationkey) AS fn FROM L),
FI AS (SELECT id, sii, coalesce(c_acctbal, fa) AS a, coalesce(c_nationkey, fn) AS n,
              coalesce(c_mktsegment, 'Unknown') AS s FROM L, fl),
ssc AS (SELECT avg(a) AS ma, stddev_pop(a) AS sa, avg(n) AS mn, stddev_pop(n) AS sn FROM FI),
cl AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT s AS v FROM FI))"""


def static_vec_sql(src: str) -> str:
    return (f"SELECT x.id, x.sii, (coalesce(x.c_acctbal, fa) - ma) / (CASE WHEN sa = 0 THEN 1 ELSE sa END) AS v0, "
            f"(coalesce(x.c_nationkey, fn) - mn) / (CASE WHEN sn = 0 THEN 1 ELSE sn END) AS v1, "
            f"CAST(coalesce(cl.code, -1) AS DOUBLE) AS v2 "
            f"FROM {src} x CROSS JOIN fl CROSS JOIN ssc LEFT JOIN cl ON coalesce(x.c_mktsegment, 'Unknown') = cl.v")


ORACLES["d6_static_vector"] = with_views(f"""WITH {SUBJ_FIT}, sv AS ({static_vec_sql("L")})
SELECT id, CAST(0 AS INTEGER) AS fi, round(v0, 6) AS value FROM sv
UNION ALL SELECT id, CAST(1 AS INTEGER), round(v1, 6) FROM sv
UNION ALL SELECT id, CAST(2 AS INTEGER), round(v2, 6) FROM sv""", "subj")

ORACLES["b7_restrict_to_available"] = with_views(
    "SELECT id, sii FROM subj WHERE sii IS NOT NULL AND id IN (SELECT id FROM series)", "subj", "series")

SAMPLES = SEQ_CTE + """,
qs AS (SELECT id, CAST(count(*) AS INTEGER) AS n_steps, round(sum(x0 + x1 + x2), 6) AS seq_sum FROM q GROUP BY id),
""" + SUBJ_FIT
ORACLES["b8_assemble_samples"] = with_views(SAMPLES + f""", sv AS ({static_vec_sql("L")})
SELECT sv.id, sv.sii, qs.n_steps, qs.seq_sum, round(v0 + v1 + v2, 6) AS static_sum FROM sv JOIN qs ON sv.id = qs.id""",
                                            "subj", "series")
ORACLES["h8_prepare_inference"] = with_views(SAMPLES + f""", sv AS ({static_vec_sql("subj")})
SELECT sv.id, qs.n_steps, qs.seq_sum, round(v0 + v1 + v2, 6) AS static_sum FROM sv JOIN qs ON sv.id = qs.id""",
                                             "subj", "series")

ORACLES["b2_common_columns"] = with_views("SELECT o_orderkey, o_totalprice, c_mktsegment, y FROM tab", "tab")
ORACLES["b3_common_static_columns"] = with_views("SELECT o_orderkey, o_totalprice, c_mktsegment FROM tab", "tab")
ORACLES["b4_drop_columns"] = with_views("SELECT o_totalprice, o_orderstatus, c_mktsegment, y FROM tab", "tab")
ORACLES["b6_align_columns"] = with_views(
    "SELECT o_orderkey, o_totalprice, CAST(NULL AS DOUBLE) AS c_acctbal, '0' AS o_orderstatus, c_mktsegment "
    "FROM tab_new", "tab_new")
ORACLES["d5_transform_new_rows"] = tab_prep_sql("median", new=True)


# ----------------------------------------------- impute & encode steps (C, D)
ORACLES["c1_median_impute"] = with_views("""WITH m AS (SELECT median(o_totalprice) AS a, median(c_acctbal) AS b FROM tab)
SELECT o_orderkey, round(coalesce(o_totalprice, a), 6) AS o_totalprice, round(coalesce(c_acctbal, b), 6) AS c_acctbal
FROM tab, m""", "tab")
ORACLES["c4_most_frequent_impute"] = with_views(
    f"SELECT o_orderkey, coalesce(o_orderstatus, {mode_sql('o_orderstatus', 'tab')}) AS o_orderstatus, "
    f"coalesce(c_mktsegment, {mode_sql('c_mktsegment', 'tab')}) AS c_mktsegment FROM tab", "tab")
ORACLES["c5_fill_unknown"] = with_views("SELECT id, coalesce(c_mktsegment, 'Unknown') AS c_mktsegment FROM subj", "subj")
ORACLES["d1_standardize"] = with_views("""WITH s AS (SELECT avg(o_totalprice) AS ma, stddev_pop(o_totalprice) AS sa,
  avg(c_acctbal) AS mb, stddev_pop(c_acctbal) AS sb FROM tab)
SELECT o_orderkey, round((o_totalprice - ma) / (CASE WHEN sa = 0 THEN 1 ELSE sa END), 6) AS o_totalprice,
       round((c_acctbal - mb) / (CASE WHEN sb = 0 THEN 1 ELSE sb END), 6) AS c_acctbal FROM tab, s""", "tab")
ORACLES["d3_onehot"] = with_views("""WITH ca AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS r FROM (SELECT DISTINCT o_orderstatus AS v FROM tab WHERE o_orderstatus IS NOT NULL)),
cb AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS r FROM (SELECT DISTINCT c_mktsegment AS v FROM tab WHERE c_mktsegment IS NOT NULL))
SELECT o_orderkey, CAST(ca.r AS INTEGER) AS fi, 'o_orderstatus_' || ca.v AS feature,
       round(CASE WHEN o_orderstatus = ca.v THEN 1.0 ELSE 0.0 END, 6) AS value FROM tab, ca
UNION ALL
SELECT o_orderkey, CAST((SELECT count(*) FROM ca) + cb.r AS INTEGER), 'c_mktsegment_' || cb.v,
       round(CASE WHEN c_mktsegment = cb.v THEN 1.0 ELSE 0.0 END, 6) FROM tab, cb""", "tab")
ORACLES["d4_label_encode"] = with_views("""WITH f AS (SELECT id, coalesce(c_mktsegment, 'Unknown') AS s FROM subj),
cl AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT s AS v FROM f))
SELECT id, CAST(code AS DOUBLE) AS code FROM f JOIN cl ON f.s = cl.v""", "subj")


# ------------------------------------------------------- feature selection (F)
FEAT = "feat AS (" + tab_prep_sql("median", rnd=False) + "),\nfy AS (SELECT f.o_orderkey, f.fi, f.value AS x, t.y FROM feat f JOIN tab t ON f.o_orderkey = t.o_orderkey)"


def topk_sql(score_cte: str, k: int) -> str:
    return (f"SELECT CAST(fi AS INTEGER) AS fi, round(score, 6) AS score, "
            f"(row_number() OVER (ORDER BY (score IS NULL OR isnan(score)), score DESC, fi DESC) <= {k}) AS selected "
            f"FROM {score_cte}")


ORACLES["f0_none"] = tab_prep_sql("median")
ORACLES["f10_variance_threshold"] = with_views(f"""WITH {FEAT},
s AS (SELECT fi, var_pop(x) AS score FROM fy GROUP BY fi)
SELECT CAST(fi AS INTEGER) AS fi, round(score, 6) AS score, score > 0.01 AS selected FROM s""", "tab")
ANOVA = """g AS (SELECT fi, y, count(*) AS n, avg(x) AS m, var_pop(x) AS v FROM fy GROUP BY fi, y),
gt AS (SELECT fi, sum(n) AS nn, count(*) AS kk, sum(n * m) / sum(n) AS gm FROM g GROUP BY fi),
s AS (SELECT g.fi, (sum(n * (m - gm) * (m - gm)) / (max(kk) - 1)) / NULLIF(sum(n * v) / (max(nn) - max(kk)), 0) AS score
      FROM g JOIN gt ON g.fi = gt.fi GROUP BY g.fi)"""
ORACLES["f7_f_classif"] = with_views(f"WITH {FEAT},\n{ANOVA}\n" + topk_sql("s", 4), "tab")
ORACLES["f8_chi2"] = with_views("""WITH l AS (SELECT * FROM tab WHERE y IS NOT NULL),
ca AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS r FROM (SELECT DISTINCT o_orderstatus AS v FROM l WHERE o_orderstatus IS NOT NULL)),
cb AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS r FROM (SELECT DISTINCT c_mktsegment AS v FROM l WHERE c_mktsegment IS NOT NULL)),
fy AS (SELECT o_orderkey, y, ca.r AS fi, CASE WHEN o_orderstatus = ca.v THEN 1.0 ELSE 0.0 END AS x FROM l, ca
       UNION ALL SELECT o_orderkey, y, (SELECT count(*) FROM ca) + cb.r, CASE WHEN c_mktsegment = cb.v THEN 1.0 ELSE 0.0 END FROM l, cb),
o AS (SELECT fi, y, sum(x) AS o, count(*) AS n FROM fy GROUP BY fi, y),
t AS (SELECT fi, sum(o) AS tot, sum(n) AS nn FROM o GROUP BY fi),
s AS (SELECT o.fi, sum((o - n / nn * tot) * (o - n / nn * tot) / NULLIF(n / nn * tot, 0)) AS score FROM o JOIN t ON o.fi = t.fi GROUP BY o.fi)
""" + topk_sql("s", 4), "tab")
ORACLES["f6_mutual_info"] = with_views(f"""WITH {FEAT},
r AS (SELECT fi, x, row_number() OVER (PARTITION BY fi ORDER BY x) AS rn, count(*) OVER (PARTITION BY fi) AS n FROM fy),
e AS (SELECT fi, list(x) AS edges FROM r, (SELECT unnest(range(1, 10)) AS k) WHERE rn = CAST(ceil(n * k / 10) AS BIGINT) GROUP BY fi),
bn AS (SELECT fy.fi, y, len(list_filter(edges, lambda c: c < x)) AS b FROM fy JOIN e ON fy.fi = e.fi),
c AS (SELECT fi, b, y, count(*) AS n FROM bn GROUP BY 1, 2, 3),
c2 AS (SELECT *, sum(n) OVER (PARTITION BY fi) AS nn, sum(n) OVER (PARTITION BY fi, b) AS nb,
              sum(n) OVER (PARTITION BY fi, y) AS ny FROM c),
s AS (SELECT fi, sum(n / nn * ln(n * nn / (nb * ny))) AS score FROM c2 GROUP BY fi)
""" + topk_sql("s", 4), "tab")
# the k-th neighbour of the class is the least of k + 1 choices of neighbours on either side; every class has more than k rows
ORACLES["f6_mutual_info_neighbours"] = with_views(f"""WITH {FEAT},
cf AS (SELECT fi, y, count(*) AS nc FROM fy GROUP BY fi, y),
sd AS (SELECT fi, stddev_pop(x) AS sd FROM fy GROUP BY fi),
q AS (SELECT fi, y, nc, CAST(round(x / (sd * 1e-8)) AS BIGINT) AS q FROM fy JOIN cf USING (fi, y) JOIN sd USING (fi) WHERE nc > 1 AND sd > 0),
d AS (SELECT *, {", ".join(f"coalesce(q - lag(q, {j}) OVER w, 4000000000000000000) AS l{j}, coalesce(lead(q, {j}) OVER w - q, 4000000000000000000) AS r{j}" for j in (1, 2, 3))},
             count(*) OVER (PARTITION BY fi, y, q) AS own FROM q WINDOW w AS (PARTITION BY fi, y ORDER BY q)),
r AS (SELECT fi, nc, q, own, least(l3, greatest(l2, r1), greatest(l1, r2), r3) AS r FROM d),
m AS (SELECT fi, nc, CASE WHEN r > 0 THEN 3 ELSE own END AS k,
             count(*) OVER (PARTITION BY fi ORDER BY q RANGE BETWEEN greatest(r - 1, 0) PRECEDING AND greatest(r - 1, 0) FOLLOWING) AS m FROM r),
n AS (SELECT fi, count(*) AS n FROM m GROUP BY fi),
psi AS (SELECT i, coalesce(sum(1.0 / i) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS h
        FROM (SELECT unnest(range(1, (SELECT max(n) + 1 FROM n))) AS i)),
t AS (SELECT m.fi, avg(pk.h) - avg(pc.h) - avg(pm.h) AS t FROM m JOIN psi pk ON pk.i = m.k JOIN psi pc ON pc.i = m.nc JOIN psi pm ON pm.i = m.m GROUP BY m.fi),
s AS (SELECT sd.fi, coalesce(greatest(0, t + psi.h), 0) AS score FROM sd LEFT JOIN t ON t.fi = sd.fi LEFT JOIN n ON n.fi = sd.fi LEFT JOIN psi ON psi.i = n.n)
""" + topk_sql("s", 4), "tab")
# covariances as a list of lists, in the order of the features
_COV = """pr AS (SELECT a.fi AS i, b.fi AS j, covar_pop(a.x, b.x) AS v FROM fy a JOIN fy b ON a.o_orderkey = b.o_orderkey GROUP BY 1, 2),
cv AS (SELECT list(r ORDER BY i) AS a FROM (SELECT i, list(v ORDER BY j) AS r FROM pr GROUP BY i))"""
# cyclic coordinate descent from zero, one coordinate a step
ORACLES["f1_lasso"] = with_views(f"""WITH {FEAT},
{_COV},
cy AS (SELECT list(v ORDER BY fi) AS c, count(*) AS p FROM (SELECT fi, covar_pop(x, y) AS v FROM fy GROUP BY fi)),
w(step, w) AS (SELECT 0, list_transform(c, lambda v: CAST(0 AS DOUBLE)) FROM cy
  UNION ALL
  SELECT step + 1, list_transform(w, lambda v, k: CASE WHEN k = j AND d > 0 THEN sign(r) * greatest(abs(r) - 0.01, 0) / d ELSE v END)
  FROM (SELECT step, w, j, a[j][j] AS d, c[j] - list_dot_product(a[j], w) + a[j][j] * w[j] AS r FROM (SELECT *, step % p + 1 AS j FROM w, cy, cv)) WHERE step < 3000),
l AS (SELECT unnest(range(len(w))) AS fi, unnest(w) AS score FROM w WHERE step = 3000)
SELECT CAST(fi AS INTEGER) AS fi, round(score, 6) AS score, score <> 0 AS selected FROM l""", "tab").replace("WITH", "WITH RECURSIVE", 1)


def _component_sql(n: int) -> str:
    """The n-th component: the covariance without the ones before is squared until one direction is left of it."""
    return f"""s{n}(step, m) AS (SELECT 0, a FROM c{n} UNION ALL
  SELECT step + 1, list_transform(q, lambda r: list_transform(r, lambda x: x / list_sum(list_transform(q, lambda y, i: y[i])))) FROM (
    SELECT step, list_transform(m, lambda r: list_transform(m, lambda o: list_dot_product(r, o))) AS q FROM s{n}) WHERE step < 30),
d{n} AS (SELECT m, list_transform(m, lambda r, i: r[i]) AS diag FROM s{n} WHERE step = 30),
v{n} AS (SELECT list_transform(m[j], lambda x: x / sqrt(m[j][j])) AS v FROM (SELECT m, list_position(diag, list_max(diag)) AS j FROM d{n})),
c{n + 1} AS (SELECT list_transform(a, lambda r, i: list_transform(r, lambda x, j: x - v[i] * v[j] * list_dot_product(v, list_transform(a, lambda y: list_dot_product(y, v))))) AS a
             FROM c{n}, v{n})"""


ORACLES["f9_pca"] = with_views(f"""WITH {FEAT},
{_COV},
c1 AS (SELECT a FROM cv),
{", ".join(map(_component_sql, (1, 2, 3)))},
mu AS (SELECT fi, avg(x) AS mu FROM fy GROUP BY fi)
SELECT o_orderkey, {", ".join(f"round(sum((x - mu) * v{n}.v[fy.fi + 1]), 6) AS PC{n}" for n in (1, 2, 3))}
FROM fy JOIN mu ON fy.fi = mu.fi, v1, v2, v3 GROUP BY o_orderkey""", "tab").replace("WITH", "WITH RECURSIVE", 1)
# the classes lie apart, and a trained network tells them
ORACLES["e1_fit_relu_network"] = "SELECT vec_id, label, label AS prediction FROM embeddings WHERE label < 3"
ORACLES["f11_correlation_threshold"] = with_views(f"""WITH {FEAT},
pr AS (SELECT a.fi AS i, b.fi AS j, covar_pop(a.x, b.x) / NULLIF(stddev_pop(a.x) * stddev_pop(b.x), 0) AS r
       FROM fy a JOIN fy b ON a.o_orderkey = b.o_orderkey AND a.fi < b.fi GROUP BY 1, 2),
dr AS (SELECT j AS fi, bool_or(abs(r) > 0.9) AS redundant FROM pr GROUP BY j),
ry AS (SELECT fi, abs(covar_pop(x, y) / NULLIF(stddev_pop(x) * stddev_pop(y), 0)) AS abs_r FROM fy GROUP BY fi)
SELECT CAST(ry.fi AS INTEGER) AS fi, round(abs_r, 6) AS abs_r, coalesce(redundant, false) AS redundant,
       (abs_r > 0.01 AND NOT coalesce(redundant, false)) AS selected FROM ry LEFT JOIN dr ON ry.fi = dr.fi""", "tab")
ORACLES["f12_apply_selection"] = with_views(f"""WITH {FEAT},
{ANOVA},
k AS (SELECT fi FROM ({topk_sql("s", 4)}) WHERE selected),
kn AS (SELECT fi, row_number() OVER (ORDER BY fi) - 1 AS nfi FROM k),
nw AS ({tab_prep_sql("median", new=True)})
SELECT nw.o_orderkey, CAST(kn.nfi AS INTEGER) AS fi, nw.feature, nw.value FROM nw JOIN kn ON nw.fi = kn.fi""", "tab", "tab_new")


# ------------------------------------------------------------- scoring (E)
def _lit(v: float) -> str:
    return f"CAST({float(v)!r} AS DOUBLE)"


def _affine(W, b, xs):
    return [" + ".join([_lit(b[j])] + [f"{_lit(W[j][i])} * {xs[i]}" for i in range(len(xs))]) for j in range(len(W))]


def _softmax_cols(src: str, n: int) -> str:
    ls = [f"l{i}" for i in range(n)]
    m = f"greatest({', '.join(ls)})"
    den = " + ".join(f"exp({l} - {m})" for l in ls)
    arg = "CASE " + " ".join(
        f"WHEN {' AND '.join(f'l{i} >= l{j}' for j in range(i + 1, n))} THEN {i}" for i in range(n - 1)
    ) + f" ELSE {n - 1} END"
    probs = ", ".join(f"round(exp(l{i} - {m}) / ({den}), 6) AS p{i}" for i in range(n))
    return f"SELECT id, CAST({arg} AS INTEGER) AS prediction, {probs} FROM {src}"


def mlp_sql(src: str, xs, layers) -> str:
    ctes, sel = mlp_parts(src, xs, layers)
    return ctes + "\n" + sel


def mlp_parts(src: str, xs, layers):
    """CTE chain computing an MLP over columns ``xs`` of ``src`` (needs id),
    and the final SELECT of (id, prediction, p0…)."""
    ctes, cur, cols = [], src, list(xs)
    for k, (W, b) in enumerate(layers):
        last = k == len(layers) - 1
        exprs = _affine(W, b, cols)
        names = [f"l{j}" for j in range(len(W))] if last else [f"h{k}_{j}" for j in range(len(W))]
        body = ", ".join((f"({e}) AS {nm}" if last else f"greatest(0, {e}) AS {nm}") for e, nm in zip(exprs, names))
        ctes.append(f"mlp{k} AS (SELECT id, {body} FROM {cur})")
        cur, cols = f"mlp{k}", names
    return ",\n".join(ctes), _softmax_cols(cur, len(layers[-1][0]))


def highway_sql(src: str, xs, net) -> str:
    ctes, cur, cols = [], src, list(xs)
    for k, ((W, b), (V, c)) in enumerate(zip(net["layers"], net["gates"])):
        hs = _affine(W, b, cols)
        ts = _affine(V, c, cols)
        body = ", ".join(f"(1.0 / (1.0 + exp(-({t})))) * greatest(0, {h}) + (1 - 1.0 / (1.0 + exp(-({t})))) * {x} AS z{k}_{j}"
                         for j, (h, t, x) in enumerate(zip(hs, ts, cols)))
        ctes.append(f"hw{k} AS (SELECT id, {body} FROM {cur})")
        cur, cols = f"hw{k}", [f"z{k}_{j}" for j in range(len(cols))]
    W, b = net["out"]
    ctes.append(f"hwo AS (SELECT id, {', '.join(f'({e}) AS l{j}' for j, e in enumerate(_affine(W, b, cols)))} FROM {cur})")
    return ",\n".join(ctes) + "\n" + _softmax_cols("hwo", len(W))


def _score_oracles():
    from tessera.plans.queries import HWN_NET, MLP_NET, TAB_NET
    ctes, sel = mlp_parts("xw", ["x0", "x1", "x2", "x3"], TAB_NET)
    ORACLES["e3_predict_new_rows"] = with_views(f"""WITH {FEAT},
{ANOVA},
k AS (SELECT fi FROM ({topk_sql("s", 4)}) WHERE selected),
kn AS (SELECT fi, row_number() OVER (ORDER BY fi) - 1 AS nfi FROM k),
nw AS ({tab_prep_sql("median", new=True, rnd=False)}),
xl AS (SELECT nw.o_orderkey, kn.nfi, nw.value FROM nw JOIN kn ON nw.fi = kn.fi),
xw AS (SELECT o_orderkey AS id, max(CASE WHEN nfi = 0 THEN value END) AS x0, max(CASE WHEN nfi = 1 THEN value END) AS x1,
              max(CASE WHEN nfi = 2 THEN value END) AS x2, max(CASE WHEN nfi = 3 THEN value END) AS x3
       FROM xl GROUP BY o_orderkey),
{ctes}
{sel}""", "tab", "tab_new")
    sv = f"WITH {SUBJ_FIT}, sv AS ({static_vec_sql('L')}),\n"
    ORACLES["e3_score_mlp"] = with_views(sv + mlp_sql("sv", ["v0", "v1", "v2"], MLP_NET), "subj")
    ORACLES["e4_score_highway"] = with_views(sv + highway_sql("sv", ["v0", "v1", "v2"], HWN_NET), "subj")
    sva = f"WITH {SUBJ_FIT}, sva AS ({static_vec_sql('subj')} WHERE x.id IN (SELECT id FROM series)),\n"
    ctes, sel = mlp_parts("sva", ["v0", "v1", "v2"], MLP_NET)
    ORACLES["b13_predictions_for"] = with_views(
        sva + ctes + f",\nsc AS ({sel})\n"
        "SELECT s.id, CAST(coalesce(sc.prediction, -1) AS INTEGER) AS prediction FROM subj s LEFT JOIN sc ON s.id = sc.id",
        "subj", "series")
    ORACLES["a5_prediction_sink"] = ORACLES["b13_predictions_for"].replace(
        "AS INTEGER) AS prediction FROM subj s", "AS INTEGER) AS sii FROM subj s")


PRED_LOGITS3 = """pl AS (SELECT y, yhat, partkey,
  CASE WHEN yhat = 0 THEN 2.0 ELSE 0.5 * ((partkey + 0) % 3) END AS l0,
  CASE WHEN yhat = 1 THEN 2.0 ELSE 0.5 * ((partkey + 1) % 3) END AS l1,
  CASE WHEN yhat = 2 THEN 2.0 ELSE 0.5 * ((partkey + 2) % 3) END AS l2 FROM pred)"""


def _sm3(src):
    return ("SELECT y, {extra}CAST(CASE WHEN l0 >= l1 AND l0 >= l2 THEN 0 WHEN l1 >= l2 THEN 1 ELSE 2 END AS INTEGER) AS prediction, "
            "round(exp(l0 - greatest(l0, l1, l2)) / (exp(l0 - greatest(l0, l1, l2)) + exp(l1 - greatest(l0, l1, l2)) + exp(l2 - greatest(l0, l1, l2))), 6) AS p0, "
            "round(exp(l1 - greatest(l0, l1, l2)) / (exp(l0 - greatest(l0, l1, l2)) + exp(l1 - greatest(l0, l1, l2)) + exp(l2 - greatest(l0, l1, l2))), 6) AS p1, "
            "round(exp(l2 - greatest(l0, l1, l2)) / (exp(l0 - greatest(l0, l1, l2)) + exp(l1 - greatest(l0, l1, l2)) + exp(l2 - greatest(l0, l1, l2))), 6) AS p2 "
            f"FROM {src}")


ORACLES["e6_softmax_argmax"] = with_views(f"WITH {PRED_LOGITS3}\n" + _sm3("pl").format(extra="yhat, "), "pred")
# NaN logits count as 0 (NaN → 0 before softmax / arg-max)
ORACLES["e7_nan_logits"] = with_views(
    f"WITH {PRED_LOGITS3}, pn AS (SELECT y, l0, CASE WHEN partkey % 5 = 0 THEN 0.0 ELSE l1 END AS l1, l2 FROM pl)\n"
    + _sm3("pn").format(extra=""), "pred")


ORACLES["c3_knn_impute"] = with_views(f"""WITH tt AS (SELECT o_orderkey, o_totalprice, c_acctbal FROM tab),
{_knn_col("o_totalprice", "c_acctbal")},
{_knn_col("c_acctbal", "o_totalprice")},
m AS (SELECT avg(o_totalprice) AS m1, avg(c_acctbal) AS m2 FROM tt)
SELECT tt.o_orderkey, round(coalesce(tt.o_totalprice, k1.imp, m1), 6) AS o_totalprice,
       round(coalesce(tt.c_acctbal, k2.imp, m2), 6) AS c_acctbal
FROM tt LEFT JOIN k_o_totalprice k1 ON tt.o_orderkey = k1.rk LEFT JOIN k_c_acctbal k2 ON tt.o_orderkey = k2.rk, m""",
                                      "tab")

ORACLES["g4_smote"] = with_views(f"""WITH cnt AS (SELECT label, count(*) AS n_c FROM vec GROUP BY 1),
need AS (SELECT label, n_c, max(n_c) OVER () - n_c AS d FROM cnt),
mino AS (SELECT v.* FROM vec v JOIN need USING (label) WHERE d > 0),
pairs AS (SELECT a.label, a.vec_id AS q, b.vec_id AS nn,
                 list_sum(list_transform(list_zip(a.features, b.features), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d2
          FROM mino a JOIN mino b ON a.label = b.label AND a.vec_id <> b.vec_id),
knn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY d2, nn) AS nr FROM pairs) WHERE nr <= 5),
kn AS (SELECT q, count(*) AS kn FROM knn GROUP BY q),
rk AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY substr(md5('42:' || vec_id), 1, 15), vec_id) AS rk FROM mino),
dr AS (SELECT label, n_c, unnest(range(d)) AS i FROM need WHERE d > 0),
dj AS (SELECT label, i, {H60("'42:' || label || ':' || i || ':b'")} % n_c + 1 AS rk,
              CAST(('0x' || substr(md5('42:' || label || ':' || i || ':u'), 1, 8))::UBIGINT AS DOUBLE) / 4294967296.0 AS u
       FROM dr),
base AS (SELECT dj.label, dj.i, dj.u, rk.vec_id, rk.features, kn.kn FROM dj JOIN rk ON dj.label = rk.label AND dj.rk = rk.rk
         JOIN kn ON kn.q = rk.vec_id),
bp AS (SELECT base.*, {H60("'42:' || label || ':' || i || ':n'")} % kn + 1 AS nr FROM base),
syn AS (SELECT bp.vec_id, bp.label, CAST(bp.i AS BIGINT) AS synthetic,
               list_transform(list_zip(bp.features, o.features), lambda z: z[1] + bp.u * (z[2] - z[1])) AS features
        FROM bp JOIN knn ON knn.q = bp.vec_id AND knn.nr = bp.nr JOIN vec o ON o.vec_id = knn.nn),
allr AS (SELECT vec_id, label, CAST(-1 AS BIGINT) AS synthetic, features FROM vec UNION ALL SELECT * FROM syn)
SELECT vec_id, label, synthetic, CAST(g.i - 1 AS INTEGER) AS dim, round(features[g.i], 6) AS value
FROM allr, LATERAL (SELECT unnest(range(1, len(features) + 1)) AS i) g""", "vec")


# ------------------------------------------------------- end-to-end pipeline
ORACLES["p1_fit_transform_fclassif_under"] = with_views(f"""WITH {FEAT},
{ANOVA},
k AS (SELECT fi FROM ({topk_sql("s", 4)}) WHERE selected),
kn AS (SELECT fi, row_number() OVER (ORDER BY fi) - 1 AS nfi FROM k),
lab AS (SELECT o_orderkey, y FROM tab WHERE y IS NOT NULL),
cnt AS (SELECT y, count(*) AS n_c FROM lab GROUP BY 1),
rk AS ({ranked_sql("lab", "o_orderkey", "y")}),
kept AS (SELECT o_orderkey FROM rk WHERE rk <= (SELECT min(n_c) FROM cnt))
SELECT f.o_orderkey, CAST(kn.nfi AS INTEGER) AS fi, f.feature, round(f.value, 6) AS value
FROM feat f JOIN kn ON f.fi = kn.fi JOIN kept ON f.o_orderkey = kept.o_orderkey""", "tab")
ORACLES["p2_transform_new_rows"] = ORACLES["f12_apply_selection"]


# ---------------------------------------------------------- sources (A)
ORACLES["a1_read_table_string_key"] = "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_acctbal FROM customer"
ORACLES["a3_read_series_layout"] = with_views(
    "SELECT id, event_id, round(value, 6) AS value, round(k, 6) AS k FROM series", "series")
ORACLES["a8_profile"] = ("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, "
                         "(SELECT count(*) FROM customer) AS n_rows, CAST(5 AS INTEGER) AS n_cols "
                         "FROM customer ORDER BY c_custkey LIMIT 5")
ORACLES["a7_metrics_history"] = with_views(f"""WITH {PRED_L}, {SCORES},
lo AS (SELECT round(avg(bl), 6) AS loss FROM (SELECT batch, avg(loss) AS bl FROM ls GROUP BY 1)),
ep AS (SELECT unnest([1, 2]) AS epoch)
SELECT 'mod=mlp-fts=f_classif-k=4-imb=class_weight' AS run, CAST(epoch AS INTEGER) AS epoch, loss, accuracy,
       balanced_accuracy, precision, recall, f1 FROM sc, lo, ep""", "pred")


# E5: the hybrid LSTM as a recursive CTE over each subject's steps
def _sig(e: str) -> str:
    return f"(0.5 * (1 + tanh(0.5 * ({e}))))"


def hybrid_sql() -> str:
    from tessera.plans.queries import HYB_NET
    (Wih, Whh, bih, bhh), = HYB_NET["lstm"]
    H = len(Whh[0])
    xs = ["q.x0", "q.x1", "q.x2"]
    hs = [f"r.h{j}" for j in range(H)]
    bias = [bih[i] + bhh[i] for i in range(4 * H)]
    z = [" + ".join([_lit(bias[i])] + [f"{_lit(Wih[i][a])} * {xs[a]}" for a in range(len(xs))]
                    + [f"{_lit(Whh[i][b])} * {hs[b]}" for b in range(H)]) for i in range(4 * H)]
    gates = ", ".join(f"({e}) AS z{i}" for i, e in enumerate(z))
    cnew = [f"{_sig(f'z{H + j}')} * c{j} + {_sig(f'z{j}')} * tanh(z{2 * H + j})" for j in range(H)]
    step = (f"SELECT id, t, " + ", ".join(f"{cn} AS c{j}" for j, cn in enumerate(cnew)) + ", "
            + ", ".join(f"{_sig(f'z{3 * H + j}')} * tanh({cn}) AS h{j}" for j, cn in enumerate(cnew))
            + f" FROM (SELECT r.id, q.t, {', '.join(f'r.c{j} AS c{j}' for j in range(H))}, {gates} "
              f"FROM rec r JOIN q ON q.id = r.id AND q.t = r.t + 1) g")
    init = ("SELECT id, CAST(-1 AS INTEGER) AS t, " + ", ".join(f"0.0::DOUBLE AS c{j}" for j in range(H)) + ", "
            + ", ".join(f"0.0::DOUBLE AS h{j}" for j in range(H)) + " FROM (SELECT DISTINCT id FROM q)")
    Ws, bs = HYB_NET["static"]
    W1, b1 = HYB_NET["fc1"]
    W2, b2 = HYB_NET["fc2"]
    st = _affine(Ws, bs, ["sv.v0", "sv.v1", "sv.v2"])
    z1 = _affine(W1, b1, [f"h{j}" for j in range(H)] + [f"s{j}" for j in range(len(Ws))])
    body = SAMPLES + f""", sv AS ({static_vec_sql("subj")}),
rec AS ({init} UNION ALL {step}),
last AS (SELECT rec.* FROM rec JOIN (SELECT id, max(t) AS mt FROM rec GROUP BY id) m ON rec.id = m.id AND rec.t = m.mt),
br AS (SELECT last.*, {", ".join(f"greatest(0, {e}) AS s{j}" for j, e in enumerate(st))}
       FROM last JOIN sv ON sv.id = last.id),
f1 AS (SELECT id, {", ".join(f"greatest(0, {e}) AS u{j}" for j, e in enumerate(z1))} FROM br),
lg AS (SELECT id, {", ".join(f"({e}) AS l{j}" for j, e in enumerate(_affine(W2, b2, [f"u{j}" for j in range(len(W1))])))} FROM f1)
{_softmax_cols("lg", len(W2))}"""
    return with_views(body, "subj", "series").replace("WITH ", "WITH RECURSIVE ", 1)


def register_late():
    """Oracles that embed parameters (network weights) defined next to the
    queries; called once the query module is imported."""
    if "e3_score_mlp" not in ORACLES:
        _score_oracles()
        ORACLES["e5_score_hybrid"] = hybrid_sql()
        ORACLES["e5_predict_series"] = f"""
SELECT c.id, CAST(coalesce(h.prediction, -1) AS INTEGER) AS sii FROM (SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer) c
LEFT JOIN ({hybrid_sql()}) h ON c.id = h.id"""

ORACLES["c3_pipeline_knn"] = tab_prep_sql("knn")

ORACLES["g6_tab_datasets_fit_all"] = with_views("""WITH lab AS (SELECT o_orderkey, y FROM tab WHERE y IS NOT NULL),
cnt0 AS (SELECT y, count(*) AS n_c FROM lab GROUP BY 1),
rk0 AS (""" + ranked_sql("lab", "o_orderkey", "y") + """),
kept AS (SELECT o_orderkey, y FROM rk0 WHERE rk <= (SELECT min(n_c) FROM cnt0)),
""" + strat_sql("kept", "y", "o_orderkey") + """
SELECT o_orderkey, y, split FROM sp""", "tab")

ORACLES["g6_tab_datasets_fit_train"] = tab_prep_sql(
    "median", pre="lab AS (SELECT * FROM tab WHERE y IS NOT NULL),\n" + strat_sql("lab", "y", "o_orderkey") + ",\n",
    l_sql="SELECT * FROM sp WHERE split = 'train'", app_src="lab")

ORACLES["b9_series_datasets_both"] = with_views(SEQ_CTE + """,
n AS (SELECT id, count(*) AS n_steps FROM q GROUP BY id),
lab AS (SELECT id, sii FROM subj WHERE sii IS NOT NULL),
""" + strat_sql("lab", "sii", "id") + """,
av AS (SELECT sp.id, sp.sii, sp.split, n.n_steps FROM sp JOIN n ON sp.id = n.id),
b AS (SELECT *, CAST((row_number() OVER (PARTITION BY split ORDER BY
        CASE WHEN split = 'train' THEN substr(md5('42:' || id), 1, 15) ELSE id END, id) - 1) // 8 AS BIGINT) AS batch_id
      FROM av)
SELECT id, sii, batch_id, CAST(n_steps AS INTEGER) AS n_steps,
       CAST(max(n_steps) OVER (PARTITION BY split, batch_id) AS INTEGER) AS padded_steps, split FROM b""",
    "subj", "series")

# the same rows must come out where missing values are NaN, where columns
# without any value are added, and where the state was saved and loaded
for _again, _first in (("d5_prep_train_nan", "d5_prep_train_median"), ("c6_all_missing_dropped", "d5_prep_train_median"),
                       ("a6_state_roundtrip", "d5_transform_new_rows"), ("a6_pipeline_model", "d5_transform_new_rows"), ("a3_series_clustered", "h5_tail"), ("d6_static_vector_nan", "d6_static_vector"),
                       ("c3_knn_impute_nan", "c3_knn_impute")):
    ORACLES[_again] = ORACLES[_first]
ORACLES["a4_missing_ids"] = with_views("SELECT id FROM subj WHERE id NOT IN (SELECT id FROM series)", "subj", "series")
ORACLES["a2_csv_string_key"] = """
SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS id, CAST(c_nationkey AS INTEGER) AS c_nationkey, round(CAST(c_acctbal AS DOUBLE), 6) AS c_acctbal
FROM customer"""
_LINES = """l AS (SELECT l_orderkey || '-' || l_linenumber AS id, CAST(l_quantity AS DOUBLE) AS x, l_returnflag AS r,
             CASE WHEN l_orderkey % 5 <> 0 THEN l_orderkey || '-' || l_partkey || '-' || l_suppkey END AS p FROM lineitem),
m AS (SELECT avg(x) AS m, stddev_pop(x) AS s FROM l)"""
ORACLES["d5_prep_many_categories"] = f"""WITH {_LINES},
r AS (SELECT r, row_number() OVER (ORDER BY r) AS i FROM (SELECT DISTINCT r FROM l)),
p AS (SELECT p, k, row_number() OVER (ORDER BY p) + (SELECT count(*) FROM r) AS i FROM (SELECT p, count(*) AS k FROM l WHERE p IS NOT NULL GROUP BY p)),
f AS (SELECT p FROM p ORDER BY k DESC, p LIMIT 1)
SELECT id, 0 AS fi, round((x - m) / s, 6) AS value FROM l, m
UNION ALL SELECT id, CAST(r.i AS INTEGER), 1.0 FROM l JOIN r ON l.r = r.r
UNION ALL SELECT id, CAST(p.i AS INTEGER), 1.0 FROM l JOIN p ON p.p = coalesce(l.p, (SELECT p FROM f))"""
ORACLES["d6_static_vector_many"] = f"""WITH {_LINES},
r AS (SELECT r, row_number() OVER (ORDER BY r) - 1 AS i FROM (SELECT DISTINCT r FROM l)),
p AS (SELECT p, row_number() OVER (ORDER BY p) - 1 AS i FROM (SELECT DISTINCT coalesce(p, 'Unknown') AS p FROM l))
SELECT id, 0 AS fi, round((x - m) / s, 6) AS value FROM l, m
UNION ALL SELECT id, 1, CAST(r.i AS DOUBLE) FROM l JOIN r ON l.r = r.r
UNION ALL SELECT id, 2, CAST(p.i AS DOUBLE) FROM l JOIN p ON p.p = coalesce(l.p, 'Unknown')"""
ORACLES["d3_onehot_sparse"] = """
WITH v AS (SELECT 0 AS ci, c_name AS v FROM customer WHERE c_custkey % 4 <> 0 UNION SELECT 1, c_mktsegment FROM customer WHERE c_custkey % 4 <> 0),
i AS (SELECT ci, v, row_number() OVER (ORDER BY ci, v) - 1 AS idx FROM v),
x AS (SELECT c_custkey, 0 AS ci, c_name AS v FROM customer UNION ALL SELECT c_custkey, 1, c_mktsegment FROM customer)
SELECT c_custkey, coalesce(string_agg(CAST(idx AS VARCHAR), ',' ORDER BY idx), '') AS slots FROM x LEFT JOIN i ON x.ci = i.ci AND x.v = i.v
GROUP BY c_custkey"""

_W = 10
ORACLES["c3_knn_impute_wide"] = with_views("WITH l AS (" + " UNION ALL ".join(
    f"SELECT vec_id, {i} AS i, CASE WHEN (vec_id * {7 + i} + {13 * i} + vec_id // {i + 2}) % 5 <> 0 THEN features[{i + 1}] END AS x FROM vec"
    for i in range(_W)) + f"""),
h AS (SELECT * FROM l WHERE x IS NOT NULL),
p AS (SELECT a.vec_id AS q, b.vec_id AS d, sqrt({_W}.0 / count(*) * sum((a.x - b.x) * (a.x - b.x))) AS dist
      FROM h a JOIN h b ON a.i = b.i AND a.vec_id <> b.vec_id GROUP BY 1, 2),
r AS (SELECT l.vec_id, l.i, h.x, row_number() OVER (PARTITION BY l.vec_id, l.i ORDER BY p.dist, p.d) AS rn
      FROM l JOIN p ON l.vec_id = p.q JOIN h ON h.vec_id = p.d AND h.i = l.i WHERE l.x IS NULL),
v AS (SELECT vec_id, i, avg(x) AS x FROM r WHERE rn <= 5 GROUP BY 1, 2),
m AS (SELECT i, avg(x) AS x FROM h GROUP BY 1),
z AS (SELECT l.vec_id, l.i, round(coalesce(l.x, v.x, m.x), 6) AS x FROM l LEFT JOIN v ON l.vec_id = v.vec_id AND l.i = v.i JOIN m ON l.i = m.i)
SELECT vec_id, """ + ", ".join(f"max(CASE WHEN i = {i} THEN x END) AS x{i}" for i in range(_W)) + " FROM z GROUP BY vec_id", "vec")
