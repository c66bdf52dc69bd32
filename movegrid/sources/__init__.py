"""Scans: domain sources (CSV, gridded arrays, images) and stand-in views."""
