"""Column functions: text, numbers, dates, collections, JSON, tail probabilities."""
