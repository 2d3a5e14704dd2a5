"""Placement rules: which site holds an order line."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

NOWHERE = 0
SITES = (1, 2)

HYDRATE = "hydrate"
STRICT = "strict"


@dataclass(frozen=True)
class CategoryClause:
    """Lines of one category above a quantity go to one site."""

    site: int
    category: int
    above: int


@dataclass(frozen=True)
class ByQuery:
    """Category and quantity decide; most lines have no site. Missing parents are pulled in."""

    clauses: tuple[CategoryClause, ...]
    name: str = "by_query"
    policy: str = HYDRATE

    @property
    def guard_above(self) -> int:
        """No clause can hold at or below this quantity."""
        return min(clause.above for clause in self.clauses)

    @property
    def categories(self) -> list[int]:
        return sorted({clause.category for clause in self.clauses})

    def site(self, quantity: Column, category: Column) -> Column:
        chosen = F.lit(NOWHERE)
        for clause in reversed(self.clauses):
            holds = (category == clause.category) & (quantity > clause.above)
            chosen = F.when(holds, F.lit(clause.site)).otherwise(chosen)
        return chosen

    load_site = site

    def next_site(self, old_site: Column, quantity: Column, category: Column) -> Column:
        return self.site(quantity, category)

    def sites_of_category(self, category: Column) -> Column:
        """Array of the sites that replicate a category."""
        return F.array_compact(
            F.array(*[F.when(category == clause.category, F.lit(clause.site)) for clause in self.clauses])
        )

    def fires(self, old_quantity: Column, new_quantity: Column) -> Column:
        """Whether a change can touch a site at all (a NULL side does not count)."""
        above = F.lit(self.guard_above)
        return F.coalesce(old_quantity > above, F.lit(False)) | F.coalesce(new_quantity > above, F.lit(False))


@dataclass(frozen=True)
class ByVolume:
    """Quantity alone decides; every line has a site. Parents must already be there."""

    threshold: int
    name: str = "by_volume"
    policy: str = STRICT

    def site(self, quantity: Column, category: Column | None = None) -> Column:
        """Routing of a new or deleted row: a NULL quantity counts as small."""
        return F.when(quantity >= self.threshold, F.lit(1)).otherwise(F.lit(2))

    def load_site(self, quantity: Column, category: Column | None = None) -> Column:
        """Routing of the first load: a NULL quantity goes nowhere."""
        return (
            F.when(quantity >= self.threshold, F.lit(1))
            .when(quantity < self.threshold, F.lit(2))
            .otherwise(F.lit(NOWHERE))
        )

    def next_site(self, old_site: Column, quantity: Column, category: Column | None = None) -> Column:
        """Routing of an updated row: an unknown comparison moves the line to the other site."""
        from_large = F.when(quantity >= self.threshold, F.lit(1)).otherwise(F.lit(2))
        from_small = F.when(quantity < self.threshold, F.lit(2)).otherwise(F.lit(1))
        return F.when(old_site == 1, from_large).otherwise(from_small)

    def fires(self, old_quantity: Column, new_quantity: Column) -> Column:
        return F.lit(True)


Rule = ByQuery | ByVolume


def by_query(category_1: int = 50, above_1: int = 100, category_2: int = 35, above_2: int = 50) -> ByQuery:
    return ByQuery((CategoryClause(1, category_1, above_1), CategoryClause(2, category_2, above_2)))


def by_volume(threshold: int = 100) -> ByVolume:
    return ByVolume(threshold)
