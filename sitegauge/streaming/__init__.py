"""Incremental (Structured Streaming) form of the price-history job."""
