"""Column expressions shared by the operators. All are built-in, none is a UDF."""
