"""Column expressions: text, time, money, thresholds and rule lists."""
