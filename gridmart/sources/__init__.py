"""Document archive, day tables, CSV export, and views over the driver tables."""
