"""Continuous flows over the same functions the batch jobs use."""
