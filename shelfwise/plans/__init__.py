"""Ready-made plans: the registered queries over the star-schema tables, and build jobs."""
