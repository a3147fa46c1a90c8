"""Reading day partitions and landed source files."""
