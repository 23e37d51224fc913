"""Operators: series windows, feature preparation, splits, quality and
exploration aggregates, evaluation metrics, scoring and model fitting."""
