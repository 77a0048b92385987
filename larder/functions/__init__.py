"""Column-level building blocks: exact sums, time parts, order-line JSON, business rules."""
