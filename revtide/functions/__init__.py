"""Column expressions: money, calendar months, billing amounts, labels."""
