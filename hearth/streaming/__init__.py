"""Streams of raw listings."""
