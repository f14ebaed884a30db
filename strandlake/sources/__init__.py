"""sources of the strandlake library."""
