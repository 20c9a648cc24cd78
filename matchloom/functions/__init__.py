"""Column functions: text, labels, scores and vectors."""
