"""DataFrame operators: joins, quality checks, ordered sums, history, metrics, decisions."""
