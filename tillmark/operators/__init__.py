"""DataFrame in, DataFrame out: nothing here triggers an action."""
