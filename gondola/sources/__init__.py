"""Readers: feed files, file selection, mapping tables and dimension scans."""
