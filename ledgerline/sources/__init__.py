"""Where data comes from and goes to: raw document folders and Parquet tables."""
