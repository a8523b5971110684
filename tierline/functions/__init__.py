"""Column expressions and shuffle helpers shared by the operators."""
