"""Column functions: no Python UDF where a built-in exists."""
