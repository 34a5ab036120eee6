"""Transforms and reports of the three datasets, and the run that joins the phases."""
