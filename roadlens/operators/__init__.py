"""Table-level operators: DataFrame in, DataFrame out, no action is run unless the name says so."""
