"""Report plans: which operators feed which table, staging of shared tables, and session settings."""
