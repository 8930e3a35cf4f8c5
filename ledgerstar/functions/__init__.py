"""Column expressions: casts, dates, text, keys, card attributes. All run inside the JVM."""
