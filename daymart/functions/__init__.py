"""Column expressions: no I/O, no shuffle, all inside the JVM."""
