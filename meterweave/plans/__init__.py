"""Plan shapes shared by several operators, and the end-to-end analysis."""
