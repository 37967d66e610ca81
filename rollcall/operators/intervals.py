"""Predicates on open-ended fuzzy intervals. Dates are text and compare as text; an empty or null bound is open."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _open(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def current(start: Column, end: Column, today: str) -> Column:
    """Both bounds inclusive."""
    return (_open(start) | (start <= today)) & (_open(end) | (end >= today))


def is_active(start: Column, end: Column, today: str) -> Column:
    """The end exclusive: who ends today isn't active."""
    return (_open(start) | (start <= today)) & (_open(end) | (end > today))


def member_now(start: Column, end: Column, today: str, strict: bool = False) -> Column:
    """Loosely, an end in the future suffices even if the start is in the future too; ``strict`` asks for both."""
    if strict:
        return current(start, end, today)
    return ((_open(start) | (start <= today)) & _open(end)) | (~_open(end) & (end >= today))


def overlaps(start: Column, end: Column, low: Column, high: Column) -> Column:
    """Strict overlap with [low, high], any of the four bounds open."""
    return (_open(low) | _open(end) | (end > low)) & (_open(high) | _open(start) | (start < high))


def holds(date: Column, start: Column, end: Column) -> Column:
    return (_open(start) | (date >= start)) & (_open(end) | (date <= end))


def sliding_window(base: Column, before: int = 30, after: int = 90) -> tuple[Column, Column]:
    return F.date_sub(base, before), F.date_add(base, after)
