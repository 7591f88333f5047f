"""Scans, landed artifacts and curated tables."""
