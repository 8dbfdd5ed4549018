"""Flat and nested output."""
