"""Column expressions.  Everything here is a composition of built-in functions and stays in the JVM."""
