"""newslens: news-veracity analytics as DataFrame, SQL and Structured Streaming jobs."""
