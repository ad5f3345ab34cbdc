"""Column-expression helpers (dates, numbers, text, encodings)."""
