"""Structured Streaming forms of scoring (R1) and daily monitoring (O2)."""
