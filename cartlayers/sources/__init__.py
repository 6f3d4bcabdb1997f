"""Reading landing files and reading or writing catalog tables."""
