"""Writers for the target tables and the run results."""
