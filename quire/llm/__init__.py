"""Training-data operators: token counts, joins, scans, search, mixing, encoding, sharding."""
