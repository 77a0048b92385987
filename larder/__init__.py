"""Order-data lakehouse jobs written with the public DataFrame API."""
