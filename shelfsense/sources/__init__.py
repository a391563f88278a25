"""Readers and writers: delimited text, rating-log lines, named collections."""
