"""Column-returning functions, all JVM-side."""
