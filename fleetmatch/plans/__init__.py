"""Jobs composed from the operators, and the query registry over the sample tables."""
