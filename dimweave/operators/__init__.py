"""Load operators: keyed joins, key allocation, dimension loads, fact loads, checks."""
