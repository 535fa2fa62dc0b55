"""Spark jobs that turn repeatedly delivered filing records into a tested star schema."""
