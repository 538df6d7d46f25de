"""Structured Streaming form of the row-level cleaning rules."""
