"""The registered queries: library calls over the given tables, each with equivalent SQL."""
