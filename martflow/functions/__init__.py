"""Column-in, column-out helpers. Everything stays inside JVM code generation."""
