"""ledgerloom: DataFrame operators over facts read from scanned financial documents."""

__version__ = "0.1.0"
