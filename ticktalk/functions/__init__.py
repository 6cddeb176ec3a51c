"""Column functions and predicates. All are built from JVM-side Spark SQL functions."""
