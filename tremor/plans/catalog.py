"""Imports every query module so that each one registers its queries."""

from tremor.plans import q_analysis, q_features, q_more, q_ops  # noqa: F401
