"""ledgerlens: card-transaction analytics as plain Spark jobs."""
