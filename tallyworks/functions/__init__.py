"""Column functions: parsing, dates and aggregates."""
