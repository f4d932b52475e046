"""The stages from sources to features, as lazy frames over one set of tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monsoon.operators import baselines, dataset, diagnose, features, gate, panel, supervise
from monsoon.operators.boost import Boosters
from monsoon.plans.adapter import TABLES, Sources, sources
from monsoon.schema import PAIR
from monsoon.sources.stages import Guards, bucketed, fingerprint, once, stage
from monsoon.sources.stored import shared_dir


@dataclass(frozen=True)
class Calendar:
    """The closed months of the test tables and the roles of their last ones."""

    start: str = "1995-01-01"
    panel_end: str = "2001-11-01"
    validation_origin: str = "2001-08-01"
    train_end: str = "2001-08-01"
    first_rolling_origin: str = "2000-09-01"
    last_rolling_origin: str = "2001-08-01"
    frozen_start: str = "2001-12-01"
    first_year: int = 1995
    last_year: int = 2002


@dataclass(frozen=True)
class Demand:
    """Frames of one set of tables.  The fact, the panel and the features at each origin are stored stages, bucketed by pair and
    checked while they are written, unless stored is False; all other frames are lazy plans over them."""

    spark: SparkSession
    sf_dir: str
    calendar: Calendar = Calendar()
    stored: bool = True

    @cached_property
    def _inputs(self) -> tuple:
        return (fingerprint(self.spark, [f"{self.sf_dir}/{t}.parquet" for t in TABLES]), self.calendar)

    def _stage(self, name: str, build: Callable[[Guards], DataFrame]) -> DataFrame:
        if not self.stored:
            return build(Guards(name))

        def write() -> str:
            guards = Guards(name)
            return bucketed(build(guards), name, PAIR, "month", guards)

        return stage(self.spark, self._inputs, name, write)

    @cached_property
    def sources(self) -> Sources:
        return sources(self.spark, self.sf_dir)

    def models(self, name: str, fit: Callable[[], Boosters]) -> Boosters:
        """Models fitted once a session over these tables; later readers load what was saved."""

        def write() -> str:
            path = f"{shared_dir(self.spark)}/models/{name}-{uuid.uuid4().hex}"
            fit().save(self.spark, path)
            return path

        return Boosters.load(self.spark, once(self.spark, self._inputs, f"models {name}", write))

    @cached_property
    def bridge(self) -> DataFrame:
        return dataset.bridge(self.sources.master_sku)

    @cached_property
    def dim_base(self) -> DataFrame:
        return dataset.dim_base(self.bridge)

    @cached_property
    def dim_branch(self) -> DataFrame:
        return dataset.dim_branch(self.sources.master_channel)

    @cached_property
    def observation(self) -> DataFrame:
        return dataset.observation(self.sources.sales, self.bridge, self.dim_branch)

    @cached_property
    def fact(self) -> DataFrame:
        def build(guards: Guards) -> DataFrame:
            obs = dataset.observation(self.sources.sales, self.bridge, self.dim_branch, guards=guards)
            return dataset.guarded_fact(dataset.fact(obs), guards)

        return self._stage("fact", build)

    @cached_property
    def pair_panel(self) -> DataFrame:
        return self._stage("pair_panel", lambda guards: panel.guarded_panel(panel.pair_panel(self.fact, self.dim_base, self.dim_branch, self.calendar.panel_end), guards))

    @cached_property
    def branch_panel(self) -> DataFrame:
        return panel.branch_panel(self.fact, self.dim_branch, self.calendar.panel_end)

    @cached_property
    def target_calendar(self) -> DataFrame:
        return panel.target_calendar(self.spark, self.calendar.first_year, self.calendar.last_year)

    @cached_property
    def pair_origin(self) -> DataFrame:
        return self._stage("pair_origin", lambda guards: features.pair_origin_features(self.pair_panel, keep=TARGETS))

    @cached_property
    def branch_origin(self) -> DataFrame:
        return features.branch_origin_features(self.branch_panel)

    @cached_property
    def pair_dev(self) -> DataFrame:
        return supervise.pair_dev_panel(self.pair_origin, self.target_calendar, self.calendar.train_end, self.calendar.validation_origin)

    @cached_property
    def branch_dev(self) -> DataFrame:
        return supervise.branch_dev_panel(self.branch_origin, self.branch_panel, self.target_calendar, self.calendar.train_end, self.calendar.validation_origin)

    @cached_property
    def states(self) -> DataFrame:
        return baselines.intermittent_states(self.pair_panel)

    @cached_property
    def origins(self) -> DataFrame:
        c = self.calendar
        return supervise.rolling_origins(self.spark, c.first_rolling_origin, c.last_rolling_origin, c.frozen_start)

    @cached_property
    def known(self) -> DataFrame:
        """The pair's own features, states and targets at each origin."""
        return self._stage("known", lambda guards: self._known())

    def _known(self) -> DataFrame:
        known = features.pair_features(self.pair_panel).withColumns({
            "current_production_forecast_mask": F.coalesce(F.col("base_current_active") & F.col("branch_current_active"), F.lit(False)), "known_pair_asof_origin": F.lit(True),
        })
        own = [c for c in known.columns if c.startswith("pair_")]
        # features and states are windows of one partitioning and order: one exchange and one sort for both
        return baselines.intermittent_states(known, keep=("current_production_forecast_mask", "known_pair_asof_origin", "months_since_last_positive", *own, *TARGETS))

    @cached_property
    def rolling(self) -> DataFrame:
        """The backtest's panel with the pair's own features, states and all experts; segment and event are those at the origin."""
        rows = supervise.rolling_panel(self.known, self.target_calendar, self.calendar.frozen_start)
        return baselines.predictions(rows).withColumns({"segment": gate.behaviour_segment(), "event": diagnose.demand_event()})

    @cached_property
    def evaluation(self) -> DataFrame:
        c = self.calendar
        at = F.col("forecast_origin").between(F.lit(c.first_rolling_origin).cast("date"), F.lit(c.last_rolling_origin).cast("date"))
        return self.rolling.where(at & supervise.primary())

    @cached_property
    def phases(self) -> DataFrame:
        return supervise.origin_phases(self.rolling, self.origins)

    @cached_property
    def calibration_choices(self) -> DataFrame:
        """The expert of each origin, horizon and segment, chosen on calibration rows only."""
        cal = supervise.origin_phases(self.rolling, self.origins, ["CAL"])
        return gate.gates_by_origin(cal, baselines.EXPERTS)


#: Columns that become targets of earlier origins.
TARGETS = ("actual_gross_m2", "actual_positive", "actual_negative_only", "target_available", "zero_semantics")
