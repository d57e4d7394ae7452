"""Plans: report specifications and the queries over the provided tables."""
