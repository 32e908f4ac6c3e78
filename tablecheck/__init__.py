"""Table quality on Spark: dictionaries, row changes, row tests, layout."""
