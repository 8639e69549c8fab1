"""Column expressions built from JVM-side functions."""
