"""The recurring upload folder as a Structured Streaming file source."""
