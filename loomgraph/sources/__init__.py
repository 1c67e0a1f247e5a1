"""Where graphs come from: relational tables, query-result JSON, stored graphs."""
