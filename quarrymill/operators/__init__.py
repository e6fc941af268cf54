"""DataFrame operators: grids, forecasts, replenishment, families, upserts, checks, reviews."""
