"""Column expressions: time, measures, ratios and levels."""
