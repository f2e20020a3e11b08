"""The same merges, driven by Structured Streaming micro-batches."""
