"""Governed views."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.quality import Rule


class AccessDenied(PermissionError):
    """A protected column was read without its grant."""


class GovernedView:
    """A frame with policy-tagged columns.

    ``tags`` maps columns to tags, ``grants`` lists the reader's tags. Without the
    grant a column is refused (``mode="deny"``) or read as NULL (``mode="mask"``);
    the other columns and row counts work either way.
    """

    def __init__(
        self, df: DataFrame, tags: dict[str, str], grants: Iterable[str] = (), mode: str = "deny"
    ) -> None:
        if mode not in ("deny", "mask"):
            raise ValueError("mode is 'deny' or 'mask'")
        granted = set(grants)
        self._df = df
        self._mode = mode
        self.protected = [c for c in df.columns if c in tags and tags[c] not in granted]

    def open(self) -> DataFrame:
        """All columns the reader may see; masked columns stay, as NULL."""
        if self._mode == "mask":
            types = {f.name: f.dataType for f in self._df.schema}
            return self._df.withColumns(
                {c: F.lit(None).cast(types[c]) for c in self.protected}
            ) if self.protected else self._df
        return self._df.drop(*self.protected)

    def select(self, *columns: str) -> DataFrame:
        """Chosen columns; under ``deny`` a protected one raises."""
        wanted = self._df.columns if not columns or columns == ("*",) else columns
        refused = [c for c in wanted if c in self.protected]
        if refused and self._mode == "deny":
            raise AccessDenied(f"no grant for columns {refused}")
        return self.open().select(*wanted)


# Governance aspect of catalog entries.
CLASSIFICATIONS = ("PUBLIC", "INTERNAL", "CONFIDENTIAL")
MINIMUM_SLO = 0.95


def catalog_rules(minimum_slo: float = MINIMUM_SLO) -> tuple[Rule, ...]:
    """Row rules for a catalog: entry(domain, aspect struct, owners array)."""
    return (
        Rule("aspect_present", "aspect", "non_null"),
        Rule("domain_matches", "aspect.domain", "equals_column", other="domain"),
        Rule("slo_sufficient", "aspect.quality_slo", "range", minimum=minimum_slo),
        Rule("classification_known", "aspect.classification", "in_set", values=CLASSIFICATIONS),
        Rule("owner_present", "owners", "not_empty"),
    )
