"""Predictive maintenance on machine telemetry, written for Apache Spark."""
