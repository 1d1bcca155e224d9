"""Settings of one warehouse."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class MartConfig:
    """What a run selects and how it joins.

    segment      the only customer segment that enters the core layer
    year         order year of the sub-category mart
    strict_keys  join on full natural keys; off, a title or code that stands for
                 several parents multiplies the lines that use it
    key_type     type of row and surrogate keys; BIGINT because INT ends at about
                 two billion lines, INT to have larger values refused
    key_buckets  tasks that can number one dimension side by side
    order_buckets  files that fact and orders are written in, by order; both sides of
                 their join are read bucket by bucket, so choose some hundred megabytes
                 of fact for each
    """

    segment: str = "Corporate"
    year: int = 2015
    strict_keys: bool = False
    key_type: str = "BIGINT"
    key_buckets: int = 4096
    order_buckets: int = 64

    def __post_init__(self) -> None:
        if self.key_type.upper() not in ("INT", "BIGINT"):
            raise ValueError(f"key_type must be INT or BIGINT, not {self.key_type}")
        if self.key_buckets < 1:
            raise ValueError("key_buckets must be at least 1")
        if self.order_buckets < 1:
            raise ValueError("order_buckets must be at least 1")
