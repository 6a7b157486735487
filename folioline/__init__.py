"""Document corpus building and search as plain PySpark DataFrame operators."""
