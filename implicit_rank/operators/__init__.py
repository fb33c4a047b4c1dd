"""Relational operators: preparation, indexing, sampling, bias model, ALS,
rankings and metrics. Plain functions DataFrame -> DataFrame."""
