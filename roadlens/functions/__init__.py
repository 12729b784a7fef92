"""Column-level helpers; everything here returns a Column and stays on the JVM."""
