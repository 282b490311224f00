"""Whole jobs: from exports to published tables and fitted models."""
