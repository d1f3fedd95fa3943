"""Bronze/Silver/Gold payment lakehouse and stream features as plain PySpark jobs."""
