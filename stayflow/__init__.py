"""Layered warehouse pipeline for hospitality feeds, written as Spark jobs."""
