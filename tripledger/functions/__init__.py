"""Column helpers that normalise one cell: text, amounts, dates, times."""
