"""Column functions: patterns, text cleaning, paths, sizes and model replies."""
