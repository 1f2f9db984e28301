"""Column -> Column expressions. All are built-in Spark SQL functions (codegen, no Python UDF)."""
