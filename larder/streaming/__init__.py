"""Incremental loading. Changes arrive as batch windows on a change column; there are no streams."""
