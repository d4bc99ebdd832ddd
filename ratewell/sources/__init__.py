"""Reading and writing review files, lookup tables, embeddings, predictions and metrics."""
