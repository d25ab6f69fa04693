"""Column expressions: type mapping, hashing, cleansing. All run inside the JVM."""
