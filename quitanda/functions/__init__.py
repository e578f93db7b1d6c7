"""Column functions: each maps Columns to a Column and stays inside generated JVM code."""
