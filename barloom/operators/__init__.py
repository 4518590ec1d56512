"""Batch operators over frames, points and bars."""
