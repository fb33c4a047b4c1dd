"""Composed plans: the registered queries with their SQL oracles, and
experiment plans (grids, sweeps, run logs)."""
