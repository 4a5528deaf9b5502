"""Jobs, served queries and the registry of checked queries."""
