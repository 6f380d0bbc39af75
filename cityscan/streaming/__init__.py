"""Structured Streaming: incremental form of the CSV → Parquet ingest."""

from cityscan.streaming.ingest import start_incident_ingest, start_incident_ingest_checked

__all__ = ["start_incident_ingest", "start_incident_ingest_checked"]
