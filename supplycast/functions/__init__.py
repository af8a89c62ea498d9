"""Column expressions and small numeric helpers shared by the operators."""
