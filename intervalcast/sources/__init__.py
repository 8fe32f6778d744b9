"""Tables, message buses, sinks, saved models and scratch space."""
