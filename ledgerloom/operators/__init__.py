"""The analysis operators: DataFrame(s) in, DataFrame out."""
