"""Table operators: conform, clean, filter, transform, score, enrich, check."""
