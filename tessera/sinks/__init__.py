"""Writers for the job outputs."""
