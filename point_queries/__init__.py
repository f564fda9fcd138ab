"""The point operators as queries over the given tables, with their SQL."""
