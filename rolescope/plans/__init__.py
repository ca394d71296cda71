"""Complete jobs made of operators, and the query catalogue over the test tables."""
