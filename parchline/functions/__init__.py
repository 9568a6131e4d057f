"""Column expressions. All stay in the JVM."""
