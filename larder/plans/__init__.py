"""Data products (``products``), their registry, and the jobs that load, derive and publish them."""
