"""Target-site, k-mer and off-target analytics as Spark DataFrame transformations."""
