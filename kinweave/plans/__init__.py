"""Plans: rule sets and whole jobs put together from the operators."""
