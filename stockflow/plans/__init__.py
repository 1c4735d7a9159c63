"""The data models and the jobs that build them."""
