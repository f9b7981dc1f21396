"""Table-level operators: DataFrame in, DataFrame out, Catalyst all the way."""
