"""Media engagement analytics on Spark: raw JSON in, a small star schema and reports out."""
