"""Jobs, their defaults, and the registered queries."""
