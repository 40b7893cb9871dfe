"""Whole corpora: operators put together, one lazy DataFrame each."""
