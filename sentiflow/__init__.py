"""Customer-review text analytics on Spark. Functions from DataFrame to DataFrame."""
