"""Column functions: one row in, one value out, evaluated inside the JVM."""
