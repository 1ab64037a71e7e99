"""Column functions: text, URLs, dates, hashes."""
