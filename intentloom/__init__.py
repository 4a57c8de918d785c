"""Intent features and retrieval artefacts for all users, on Spark DataFrames."""
