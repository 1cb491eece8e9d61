"""The datasets: ingest, voter dimension, stage, marts, calendars, checks and dashboard tables."""
