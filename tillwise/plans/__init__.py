"""Whole jobs: batch load, recompute, dashboards and the insight report."""
