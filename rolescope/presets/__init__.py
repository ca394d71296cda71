"""Ready-made role descriptions of known tables."""
