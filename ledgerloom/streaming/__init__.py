"""Streaming of ledgerloom."""
