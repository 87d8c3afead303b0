"""End-to-end plans: ingest (plain and bucketed), the report runner, model
training and scoring, the batch run, concurrent writes."""
