"""Streaming counterparts of the reports, on Structured Streaming."""
