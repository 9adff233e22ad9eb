"""Single steps, each a function from DataFrames to a DataFrame."""
