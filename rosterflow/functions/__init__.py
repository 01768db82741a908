"""Column expressions; all stay in the JVM."""
