"""DataFrame-in, DataFrame-out operators: quality, volume, checks, correlation, silver, gold."""
