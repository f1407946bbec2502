"""Training, promotion and ranking on Spark ML."""
