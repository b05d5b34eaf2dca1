"""The jobs and queries: silver, gold, quality, views and reads."""
