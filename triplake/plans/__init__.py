"""End-to-end plans (the jobs): clean, gold, export, checks, profile."""
