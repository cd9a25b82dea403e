"""Composed jobs: the end-to-end classification and the analytic reports."""
