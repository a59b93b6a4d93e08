"""Every registered query runs on sf0.001 and keeps a stable schema."""

import pytest

import __spark_entry__ as E
from tessera.plans.queries import QUERIES
from tests.conftest import SF


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["o_orderkey", "fi", "feature", "value"]


def test_every_query_has_oracle_or_is_model_based():
    no_oracle = set(QUERIES) - set(E.oracle_sql())
    assert no_oracle <= {"f2_lasso_cv", "f3_random_forest", "f4_rf_importance",
                         "f5_logistic_regression", "e1_fit_mlp", "e2_fit_weighted_linear",
                         "e5_score_hybrid", "f9_series_static_pca"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs(spark, name):
    df = E.queries()[name](spark, SF)
    cols = df.columns
    df.limit(5).collect()
    assert len(cols) == len(set(cols))


def test_hybrid_scores_equal_numpy_per_sample(spark):
    from tessera.operators import score as sco
    from tessera.plans import queries as Q
    from tessera.plans import series_prep as sp
    from tessera.sources import fixtures as fx
    st = sp.fit_static(fx.subjects(spark, SF), "id", "sii")
    s = sp.assemble(fx.subjects(spark, SF), fx.series(spark, SF), st, Q.SER_ORDER, Q.EVERY, Q.TAIL, labelled=False)
    samples = {r["id"]: (r["seq"], r["static"]) for r in s.collect()}
    got = {r["id"]: r["logits"] for r in sco.score_hybrid(s, Q.HYB_NET).collect()}
    import numpy as np
    assert set(got) == set(samples) and samples
    for i, (seq, stat) in samples.items():
        assert np.allclose(got[i], sco.hybrid_forward(np.asarray(seq), np.asarray(stat), Q.HYB_NET))
