"""DataFrame operators: quality checks, merges, versioning, sequences, dimensions."""
