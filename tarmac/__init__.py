"""Flight delay analytics as Spark jobs: ingestion, delay marts, features, model."""
