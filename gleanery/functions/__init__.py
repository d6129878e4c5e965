"""Column expressions and Arrow block kernels shared by the operators."""
