"""Operators of ledgerloom."""
