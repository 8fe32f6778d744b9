"""Event time, windows, scoring and supervision of streams."""
