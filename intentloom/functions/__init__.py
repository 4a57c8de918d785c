"""Column functions: each takes and returns a Column and stays in the JVM."""
