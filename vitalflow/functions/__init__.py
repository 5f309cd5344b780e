"""Column expressions: every per-row rule of the pipeline as a JVM-side Column."""
