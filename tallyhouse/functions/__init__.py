"""Column helpers built from Spark's own functions; nothing here leaves the JVM."""
