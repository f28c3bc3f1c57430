"""The package's operators run over the given tables, and the SQL they must agree with."""
