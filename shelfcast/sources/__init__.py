"""Reading and writing tables, documents, artifacts and run metrics."""
