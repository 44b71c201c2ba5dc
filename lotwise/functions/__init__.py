"""Column -> Column functions. Everything here is built from JVM-side expressions."""
