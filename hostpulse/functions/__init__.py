"""Column functions: text cleaning, time, payload JSON and embeddings."""
