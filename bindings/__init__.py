"""The library bound to the TPC-H-like benchmark tables, with the same questions as SQL."""
