"""Reusable distributed operators: ordering, quality checks, cleaning, sampling."""
