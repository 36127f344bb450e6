"""Readers: delimited exports, versioned snapshots and JSON-lines logs."""
