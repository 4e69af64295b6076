"""Column-level building blocks: casts, text, derived measures, nested text."""
