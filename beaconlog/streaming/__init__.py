"""Continuous ingest, exact refresh, watermarked windows, absence detection."""
