"""What a network looks like: its clock, its feeds and which of them are rail."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F

from dwelltime import fixed_values as fixed


@dataclass(frozen=True)
class Network:
    zone: str = fixed.ZONE
    feeds: dict[str, str] = field(default_factory=lambda: dict(fixed.FEED_AGENCIES))
    rail_agencies: tuple[str, ...] = (fixed.RAIL_AGENCY,)

    @property
    def agencies(self) -> list[str]:
        return list(self.feeds.values())

    def agency_of(self, feed: Column) -> Column:
        pairs = [F.lit(part) for pair in self.feeds.items() for part in pair]
        return F.try_element_at(F.create_map(*pairs), feed)

    def is_rail(self, agency: Column) -> Column:
        return agency.isin(*self.rail_agencies)


LOS_ANGELES = Network()
