"""Functions of ledgerloom."""
