"""Complete jobs: training frame, training, serving, monitoring."""
