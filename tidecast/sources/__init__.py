"""Scans with declared schemas, forecast feeds, trade listings and sinks."""
