"""Column functions: each takes and returns columns, nothing touches a table."""
