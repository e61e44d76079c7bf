"""Column-level helpers (scalar functions).  All return JVM-side Columns."""
