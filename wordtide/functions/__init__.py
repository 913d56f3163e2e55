"""Column functions. Each takes and returns columns, so batch and streaming share them."""
