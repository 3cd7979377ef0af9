"""Plan shapes shared by the operators (bounded cells, quantiles, neighbor search, trees)."""
