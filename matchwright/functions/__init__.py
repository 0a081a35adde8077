"""Column expressions and whole-row cleaners; all of it stays inside the JVM."""
