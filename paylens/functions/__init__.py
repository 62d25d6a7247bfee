"""Column helpers: money and rates, time parts, labels and predicates."""
