"""Column-level functions; all of them stay inside the JVM."""
