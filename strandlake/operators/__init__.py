"""operators of the strandlake library."""
