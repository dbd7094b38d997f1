"""Operators and reports applied to the driver's tables."""

from tributary.plans.queries import columns, gold, layers, reports, runs, silver, streams, tables  # noqa: F401
