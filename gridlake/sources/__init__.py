"""Scans: run directories, decoded messages and ready-made grid tables."""
