"""Report queries and the scheduled jobs built from the operators."""
