"""Where records come from and where they go: topics, replay files, archives."""
