"""Column expressions. Everything here stays in the JVM unless its name says ``udf``."""
