"""Column -> Column helpers built only from Spark SQL built-ins (JVM side,
no Python workers)."""
