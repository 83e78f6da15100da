"""Column functions with MySQL's rules for coercion, truth, comparison, text, calendar and grouping."""
