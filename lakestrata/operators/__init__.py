"""Pure DataFrame → DataFrame operators: Silver rules, Gold builders, quality checks."""
