"""Importing this package registers every query in ``catalog``."""

from basketry.plans.queries import (  # noqa: F401
    q_sources, q_clean, q_profile, q_rules, q_joins, q_rollup, q_timeseries, q_topk, q_expr,
    q_binning, q_stats, q_govern, q_features, q_splits, q_preprocess, q_models, q_evaluate, q_scoring,
)
