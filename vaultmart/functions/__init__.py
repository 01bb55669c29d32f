"""Column expressions shared by the builders (JVM-side, codegen friendly)."""
