"""Table operations: keyed state, reads, article content, embeddings, retrieval, checks."""
