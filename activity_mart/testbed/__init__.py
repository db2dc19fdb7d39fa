"""The driver tables seen as lending extracts, for queries, oracles and the bench."""
