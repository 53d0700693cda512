"""Column functions: money, dates and text, all evaluated inside the JVM."""
