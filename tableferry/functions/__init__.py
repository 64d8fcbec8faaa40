"""Column expressions: everything here runs inside the JVM, except ``wkb``."""
