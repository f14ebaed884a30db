"""functions of the strandlake library."""
