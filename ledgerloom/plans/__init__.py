"""Plans of ledgerloom."""
