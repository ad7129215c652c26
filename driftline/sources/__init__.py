"""Readers: fixed-width lines, delimited text, compressed CSV, file listings and index pages."""
