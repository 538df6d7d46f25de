"""Operators a large-scale training-data pipeline needs, and their queries."""
