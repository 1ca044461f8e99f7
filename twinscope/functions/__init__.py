"""Column-level building blocks: text in, Column out."""
