"""Column expressions. All of them stay inside JVM code generation."""
