"""Where staging tables come from."""
