"""Plans: end-to-end jobs, the query registry and the SQL oracle twins."""
