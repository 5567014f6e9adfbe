"""The registered queries, each a library call on the given tables with its SQL twin."""
