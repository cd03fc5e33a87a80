"""Column expressions: text cleaning, HTML fields, label values."""
