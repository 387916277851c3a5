"""Plans: compositions of operators into queries and jobs."""
