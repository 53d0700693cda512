"""Table schemas, readers, writers and the adapter from the TPC-H-like test tables."""
