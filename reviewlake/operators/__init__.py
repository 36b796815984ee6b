"""Analyses as DataFrame -> DataFrame functions."""
