"""Sizes that decide between physical strategies. They change plans, never results."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Limits:
    # A lookup side is broadcast only when its measured text size is at most this.
    broadcast_bytes: int = 64 * 1024 * 1024
    # A key held by more rows than this, before or after a join, is split over several tasks.
    hot_rows: int = 1_000_000
    # Inputs of more than hot_rows rows are shuffled into so many parts that a task gets about this many.
    task_rows: int = 250_000
    # Keys are counted by this many buckets first, and one by one only in buckets that may hold a hot
    # key. From a twentieth of this times hot_rows rows on, more buckets are better: see for_rows.
    count_buckets: int = 1 << 16

    @classmethod
    def for_rows(cls, rows: int, **others) -> Limits:
        """Limits with buckets enough for inputs of so many rows."""
        made = cls(**others)
        buckets = max(made.count_buckets, 20 * rows // made.hot_rows)
        return replace(made, count_buckets=1 << (buckets - 1).bit_length())


DEFAULT = Limits()
