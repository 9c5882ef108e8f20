"""End-to-end jobs that read the shop tables and write results."""
