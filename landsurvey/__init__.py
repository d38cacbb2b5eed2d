"""Survey geodata analytics on PySpark."""
