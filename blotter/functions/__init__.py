"""Column-level expressions; everything here stays inside the JVM."""
