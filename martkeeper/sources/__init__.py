"""Scans, sinks, ingest metadata and distributed seed generation."""
