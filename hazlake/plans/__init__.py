"""Jobs that wire operators to stored tables, and the registered checks."""
