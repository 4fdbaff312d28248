"""Column expressions and small frame helpers shared by the operators."""
