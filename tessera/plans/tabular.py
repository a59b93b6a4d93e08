"""Tabular training sets: the reference's loader flow as one plan.

common columns of train/test (+ target) → fit (impute, scale, encode,
select, balance) → stratified train/validation split. ``fit_scope='train'``
(default) splits first and fits/balances on the training part only, so no
statistic of the validation rows leaks into the state; ``fit_scope='all'``
reproduces the reference's order (fit and balance on every labelled row,
then split the balanced rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tessera.operators import balance, schema
from tessera.plans import prep


def tab_datasets(train: DataFrame, test: DataFrame | None, cfg: prep.PrepConfig, train_split: float = 0.8,
                 fit_scope: str = "train"):
    """Returns (train_rows, val_rows, state, class_weights_or_None); both
    row sets carry keys, target and ``features``."""
    if fit_scope not in ("train", "all"):
        raise ValueError("fit_scope must be 'train' or 'all'")
    keys = list(cfg.keys)
    if test is not None:
        cols = schema.common_columns(train, test, target=cfg.target)
        train = train.select(*[k for k in keys if k not in cols], *cols)
    lab = schema.drop_missing_target(train, cfg.target)
    key = keys[0] if len(keys) == 1 else keys
    if fit_scope == "train":
        s = balance.stratified_split(lab, cfg.target, key, 1 - train_split, cfg.seed)
        tr, va = balance.take_split(s, "both")
        x_tr, st, w = prep.fit_transform(tr.drop("split"), cfg)
        x_va = prep.transform(va.drop("split"), st, keep=[cfg.target])
        return x_tr, x_va, st, w
    x, st, w = prep.fit_transform(lab, cfg)
    extra = [c for c in ("copy", "synthetic") if c in x.columns]
    s = balance.stratified_split(x, cfg.target, keys + extra if extra else key, 1 - train_split, cfg.seed)
    tr, va = balance.take_split(s, "both")
    return tr.drop("split"), va.drop("split"), st, w
