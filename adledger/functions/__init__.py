"""Column expressions: Column in, Column out, JVM-side unless stated."""
