"""Column expressions. None of them depends on the session time zone."""
