"""The queries the driver runs: every operator over an archive derived from the given tables."""
