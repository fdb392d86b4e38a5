"""Column builders (all JVM-side built-ins, no Python UDFs)."""
