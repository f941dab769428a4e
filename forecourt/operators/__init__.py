"""DataFrame -> DataFrame operators.  No collect, no driver loop over keys."""
