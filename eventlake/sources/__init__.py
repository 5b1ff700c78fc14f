"""Where events and tables come from."""
