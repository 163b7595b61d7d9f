"""The steps of an ingest, each usable on its own."""
