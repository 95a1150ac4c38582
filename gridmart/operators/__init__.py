"""DataFrame operators: flattening, hourly models, keys, time slots, checks, upsert."""
