"""The warehouse's transformations, one function per output table."""
