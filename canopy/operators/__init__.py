"""DataFrame operators: prepare, split, discretize, count, grow, predict, score."""
