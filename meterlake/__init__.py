"""Metering lake on Spark: raw meter readings to a verified star schema.

Every transform takes and returns a ``DataFrame``; nothing here creates a
session, sets a master or changes session settings.
"""
