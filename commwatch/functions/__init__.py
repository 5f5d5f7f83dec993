"""Column expressions, free of actions and of Python UDFs."""
