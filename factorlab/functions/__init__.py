"""Column expressions: vector algebra on arrays and the example-line parser."""
