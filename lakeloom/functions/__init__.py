"""Column expressions: every helper takes and returns Columns."""
