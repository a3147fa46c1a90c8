"""Writing typed rows into day partitions."""
