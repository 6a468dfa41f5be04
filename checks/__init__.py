"""The driver's queries on its tables, and their SQL counterparts."""
