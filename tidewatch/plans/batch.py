"""The whole batch job: bus records in, three tables out."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame

from ..contracts import DEFAULT_PIPELINE_NAME, RuleBounds
from ..functions.enrich import enrich_events, raw_event_columns
from ..functions.parse import parse_events
from ..operators.dedup import deduplicate
from ..operators.routing import dead_letters, split_events, tag_events
from ..operators.windows import aggregate_windows
from ..settings import StreamOptions, settle


@dataclass(frozen=True)
class EventTables:
    """The frames of one run, built when first asked for.

    Batch or streaming like the records they come from.  ``as_of`` replaces
    the processing clock where results must be repeatable.
    """

    records: DataFrame
    bounds: RuleBounds = RuleBounds()
    options: StreamOptions = StreamOptions()
    pipeline_name: str = DEFAULT_PIPELINE_NAME
    as_of: Column | None = None

    @cached_property
    def tagged(self) -> DataFrame:
        """Parsed records with the reason they are invalid, if they are."""
        return tag_events(parse_events(self.records), self.bounds)

    def settled(self) -> EventTables:
        """The same tables over written intermediate rows, for runs that write several.

        Records are parsed and judged once, and deduplicated once, whatever is
        then asked for.
        """
        once = replace(self)
        once.__dict__["tagged"] = settle(self.tagged, "judged")
        once.__dict__["enriched"] = settle(once.enriched, "events")
        return once

    @cached_property
    def valid(self) -> DataFrame:
        return split_events(self.tagged)[0]

    @cached_property
    def invalid(self) -> DataFrame:
        return split_events(self.tagged)[1]

    @cached_property
    def enriched(self) -> DataFrame:
        """Valid events, one per event id, with their derived columns."""
        return enrich_events(deduplicate(self.valid, self.options), self.as_of)

    @cached_property
    def raw_events(self) -> DataFrame:
        return raw_event_columns(self.enriched)

    @cached_property
    def aggregates(self) -> DataFrame:
        return aggregate_windows(
            self.enriched, self.options.window, self.options.slide, self.as_of
        )

    @cached_property
    def letters(self) -> DataFrame:
        return dead_letters(self.invalid, self.pipeline_name, self.as_of)


def event_tables(records: DataFrame, **settings) -> EventTables:
    """Parse, judge, split, deduplicate, enrich and aggregate bus records."""
    return EventTables(records, **settings)
