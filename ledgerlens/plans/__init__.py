"""Table builders and reports composed from the operators."""
