"""Marts, reports and the job that builds them."""
