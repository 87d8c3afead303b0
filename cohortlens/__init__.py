"""cohortlens: cohort funnel analytics for entities with child tables and a
lifecycle (clinical-trial registries by default), built on Spark DataFrames."""

__version__ = "0.1.0"
