"""Text and sentiment analytics for post collections and message streams, on Spark."""
