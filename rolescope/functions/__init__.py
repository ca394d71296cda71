"""Column expressions shared by the operators. Built-in Spark functions only."""
