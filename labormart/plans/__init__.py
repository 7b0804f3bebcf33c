"""Composed plans: the full and incremental pipelines, storage, registered queries."""
