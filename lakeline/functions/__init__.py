"""Column functions that stay inside the JVM."""
