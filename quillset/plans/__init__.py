"""Whole stages: files in, files and counts out."""
