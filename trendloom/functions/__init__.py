"""Column expressions shared by every job; all of them stay inside the JVM."""
