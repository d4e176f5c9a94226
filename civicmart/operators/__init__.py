"""Table-level operators: DataFrames in, DataFrames (or written tables) out."""
