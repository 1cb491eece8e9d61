"""Scans: voter files, election files, seed tables, and inputs derived from other tables."""
