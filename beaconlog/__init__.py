"""Log observability jobs on Spark: ingest, roll-ups, detectors, alerts, evidence."""
