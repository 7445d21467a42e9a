"""The verification contract: how the driver tables play the library's tables,
one query per operator, and the same query in plain SQL."""
