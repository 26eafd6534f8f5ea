"""Column expressions and distributed building blocks shared by all operators."""
