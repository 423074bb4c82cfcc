"""Scans: files, landed payloads, relative windows, high-water marks, adapter registry."""
