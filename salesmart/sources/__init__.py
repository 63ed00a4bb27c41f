"""Reading and writing: delimited files, Parquet tables, generators, literals."""
