"""Which days are covered, how full date ranges are, and what to fetch next."""
