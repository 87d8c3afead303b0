"""Relational operators over DataFrames.

cohort, rollups, master, funnel, segments, topk, audits, distributions,
features, metrics (exact ranking metrics), quantiles (exact medians), bands,
dashboard (cube, pivots, cross-filtered views)."""
