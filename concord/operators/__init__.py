"""Table-pair operators: alignment, compare, schema diff, latest partition."""
