"""DataFrame-to-DataFrame data science operators for Apache Spark."""
