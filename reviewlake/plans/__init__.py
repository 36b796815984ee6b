"""Query plans composed from operators, and the query registry."""
