"""Table operators: cleaning, vectorising, indexing, sampling, ranking, metrics, models."""
