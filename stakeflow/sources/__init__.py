"""Reading inputs, writing outputs, choosing what to load."""
