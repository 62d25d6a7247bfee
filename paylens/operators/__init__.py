"""Steps of the pipeline: ingest checks, writing and publishing tables."""
