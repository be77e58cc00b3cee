"""Column functions: expressions only, no actions and no shuffles."""
