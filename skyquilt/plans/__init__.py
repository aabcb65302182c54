"""Plan helpers: scratch tables and phase plans."""
