"""Structured Streaming counterparts of the tracked load and the monthly mean."""
