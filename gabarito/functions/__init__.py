"""Column -> Column building blocks, all JVM-side except the literal fallback in ``choices``."""
