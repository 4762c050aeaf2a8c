"""Column functions: coercion, dates, units."""
