"""Reusable plan shapes: sliding-window counting, ordered scans split into
time buckets (skew-safe running totals / predecessor lookups), top-k."""
