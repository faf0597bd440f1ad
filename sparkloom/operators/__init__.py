"""Operators: DataFrame to DataFrame. Use with ``df.transform`` or call directly."""
