"""Column expressions: text rules, keys, dates, projection and scores."""
