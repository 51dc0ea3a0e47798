"""Readers for raw files and tables, and writers for finished tables."""
