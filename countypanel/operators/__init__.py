"""DataFrame operators that take column names as parameters."""
