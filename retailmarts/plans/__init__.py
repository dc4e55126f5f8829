"""Whole pipelines: enrichment, staging, marts, KPIs, reviews, raw load."""
