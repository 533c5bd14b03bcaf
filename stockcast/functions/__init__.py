"""Column expressions; nothing here looks at data."""
