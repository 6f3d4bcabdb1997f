"""Table operators: typing, deduplication, row rules, profiling and quality checks."""
