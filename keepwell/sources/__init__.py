"""Table definitions, readers, writers and the adapter for the TPC-H-like test tables."""
