"""Column expressions and argument helpers shared by the operators."""
