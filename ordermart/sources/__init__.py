"""Readers and writers: raw feeds, processed fact, marts, text exports, snapshot tables."""
