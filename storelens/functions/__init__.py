"""Column-to-column helpers; everything stays inside generated JVM code."""
