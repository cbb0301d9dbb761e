"""Column expressions: ids, text, urls, time, geography and label values."""
