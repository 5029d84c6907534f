"""DataFrame -> DataFrame operators (no actions inside, except gates)."""
