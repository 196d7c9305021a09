"""Column-to-column functions: no joins, no UDFs."""
