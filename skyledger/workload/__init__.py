"""Station observations derived from the provided tables, the queries over them and their SQL twins."""
