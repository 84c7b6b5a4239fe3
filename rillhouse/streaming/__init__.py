"""Stream forms, runners and layer jobs."""
