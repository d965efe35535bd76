"""Plans: the table catalogue, request planning, progress, gaps and the declared table transforms."""
