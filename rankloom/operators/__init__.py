"""DataFrame operators of the ranking job."""
