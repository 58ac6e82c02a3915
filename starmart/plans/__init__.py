"""Plans: table builders, merges into published tables, analyst queries,
and the query contract on the test tables."""
