"""streaming of the strandlake library."""
