"""Table operators: DataFrames in, DataFrame out."""
