"""DataFrame-to-DataFrame operators: merges, dedupe, dimensions, metrics."""
