"""Reusable plan fragments shared by the operators."""

from catalytics.plans.fragments import (  # noqa: F401
    collect_distinct_children,
    cut_lineage,
    dealt,
    gather_children,
    spread,
    topk_per_key,
    written,
)
