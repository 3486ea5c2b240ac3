"""Column functions: pure Column-to-Column rules shared by the operators."""
