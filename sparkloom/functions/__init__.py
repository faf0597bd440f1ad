"""Column functions. All are built from Spark expressions unless a module says otherwise."""
