"""Column functions built from Spark built-ins, so they stay inside whole-stage code generation."""
