"""Reading pages, documents and seed relations, and publishing tables."""
