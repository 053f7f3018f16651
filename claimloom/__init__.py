"""Claims data-quality and star-schema jobs for Spark."""
