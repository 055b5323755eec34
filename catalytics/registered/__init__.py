"""Registered query wrappers, grouped like the operator modules."""

from catalytics.registered import changes, details, lineage, misc, search, usage  # noqa: F401
