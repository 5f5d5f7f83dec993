"""The query catalogue on the benchmark tables, with the SQL each query must agree with."""
