"""Jobs and reports."""
