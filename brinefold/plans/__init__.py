"""Front ends: requests compiled to DataFrames."""
