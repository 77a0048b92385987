"""DataFrame-to-DataFrame operators: cleaning, joins, rankings, windows, roll-ups, upsert."""
