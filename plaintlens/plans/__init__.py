"""Jobs that chain operators end to end, and the registered queries with their SQL."""
