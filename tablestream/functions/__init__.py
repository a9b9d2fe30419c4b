"""Column expressions: times, exact money and message text."""
