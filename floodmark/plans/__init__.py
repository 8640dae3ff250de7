"""Reusable plan shapes: staging, size checks, hash order, exact quantiles, running totals, time chunks."""
