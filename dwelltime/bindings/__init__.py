"""The operators bound to a TPC-H-like star schema, and the SQL to compare them with."""
