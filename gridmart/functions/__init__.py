"""Column functions: calendar, text to value, code lists."""
