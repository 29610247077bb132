"""Layered warehouse tables fed by change data capture, as plain Spark DataFrame functions."""
