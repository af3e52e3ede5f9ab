"""The streaming queries: starting, waiting for and stopping them."""
