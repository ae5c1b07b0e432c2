"""River-flow and weather analytics on Spark: ingest, features, scoring, forecasts, drift."""
