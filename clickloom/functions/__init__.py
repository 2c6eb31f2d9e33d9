"""Column expressions: everything here returns a ``Column`` and stays in the JVM."""
