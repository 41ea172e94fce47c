"""Models (staging views and marts) and the dashboard queries, composed from operators."""
