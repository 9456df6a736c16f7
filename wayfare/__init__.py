"""Trip and game analytics as plain functions from DataFrames to DataFrames."""
