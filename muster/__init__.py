"""Subscriber-list preparation, dispatch planning and outcome accounting on Spark."""
