"""plans of the strandlake library."""
