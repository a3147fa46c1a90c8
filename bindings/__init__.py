"""The operators bound to the test tables, with an independent SQL text for each."""
