"""DataFrame in, DataFrame out: one module per stage of the analysis."""
