"""The star model and the plans that build, load and question it."""
