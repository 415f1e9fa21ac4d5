"""The registered queries: the library applied to the given tables, and their SQL twins."""
