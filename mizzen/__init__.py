"""DataFrame analytics with MySQL rules for coercion, truth, calendar, grouping and row changes."""
