"""Column expressions; every one is a built-in Spark expression tree."""
