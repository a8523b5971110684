"""The same ingest, started by arriving files."""
