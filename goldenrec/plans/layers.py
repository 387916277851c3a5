"""Bronze -> silver -> gold as one lazy Catalyst plan.

``identity_layers`` composes the layer operators; nothing is executed until
the caller acts on a result. ``run_identity_job`` is the batch job form: it
writes silver once to its output folder (so the count and the join read
one copy instead of recomputing the bronze side twice, and lineage is cut) and
writes each gold table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from goldenrec import settings
from goldenrec.operators import cleaning, golden, identity, quality
from goldenrec.operators.golden import DEFAULT_ORDER, OrderKey
from goldenrec.session import materialize


@dataclass(frozen=True)
class PipelineParams:
    blank_as_null: bool = False
    priority: tuple[str, ...] = ("email", "phone")
    fallback: tuple[str, ...] = ("name", "age")
    how: str = "inner"
    partition_by: tuple[str, ...] = ("name",)
    order: tuple[OrderKey, ...] = DEFAULT_ORDER
    survivorship: str = "row"  # "row" or "attribute"
    high_above: int = settings.HIGH_ABOVE
    moderate_at: int = settings.MODERATE_AT
    source_systems: tuple[tuple[str, str], ...] = settings.SOURCE_SYSTEMS
    bronze_rules: Mapping[str, str] = field(default_factory=lambda: dict(settings.BRONZE_QUALITY_RULES))
    rule_mode: str = "warn"  # "warn" keeps failing rows, "drop" removes them
    # split out up to this many hot identifiers in the scoring join (None: off)
    hot_keys: int | None = settings.HOT_KEY_MAX_KEYS


class GoldResult:
    """Layer outputs of one run. Gold frames are planned on first access, so
    a caller that needs only silver pays nothing for gold.

    With ``materialize=True`` the identified records are written once as a
    parquet table in the cluster's shared checkpoint folder (cutting lineage)
    before the scoring join, whose hot-identifier split reads them in several
    branches (column-pruned); otherwise each branch would recompute the whole
    bronze -> silver plan. The batch job passes ``False``: its silver is
    already a table.
    """

    def __init__(self, identified: DataFrame, params: PipelineParams, materialize: bool = False):
        self.identified = identified
        self.params = params
        self._materialize = materialize

    @cached_property
    def silver(self) -> DataFrame:
        return self.identified.drop("unique_identifier")

    @cached_property
    def counts(self) -> DataFrame:
        return golden.duplicate_count(self.identified)

    @cached_property
    def _score_input(self) -> DataFrame:
        if self._materialize and self.params.hot_keys:
            return materialize(self.identified, "identified")
        return self.identified

    @cached_property
    def scored(self) -> DataFrame:
        p = self.params
        return golden.score(self._score_input, how=p.how, high_above=p.high_above, moderate_at=p.moderate_at,
                            hot_keys=p.hot_keys)

    @cached_property
    def golden(self) -> DataFrame:
        p = self.params
        if _by_identifier(self.identified, p):
            best = golden.golden_by_key(self.identified, order=p.order, how=p.how, survivorship=p.survivorship,
                                        high_above=p.high_above, moderate_at=p.moderate_at)
            cols = list(settings.SCORED_COLUMNS)
            return best.select(*cols, *[c for c in best.columns if c not in cols])
        if p.survivorship == "attribute":
            return golden.survivorship(self.scored, p.partition_by, p.order)
        return golden.golden_records(self.scored, p.partition_by, p.order)


def silver_clean(bronze: DataFrame, params: PipelineParams = PipelineParams()) -> DataFrame:
    """C15 after the bronze rules, stateless (works on a stream too)."""
    if params.rule_mode == "drop":
        bronze = quality.keep_valid(quality.typed_for_rules(bronze), params.bronze_rules)
    return cleaning.silver_clean(bronze, mapping=params.source_systems)


def silver_identified(bronze: DataFrame, params: PipelineParams = PipelineParams()) -> DataFrame:
    """C15 + K1/K2, stateless (works on a stream too)."""
    silver = silver_clean(bronze, params)
    return identity.with_identifier(silver, params.blank_as_null, params.priority, params.fallback)


def _by_identifier(identified: DataFrame, params: PipelineParams) -> bool:
    """Golden per identifier with numeric order keys: one aggregate, no join."""
    if tuple(params.partition_by) != ("unique_identifier",):
        return False
    try:
        golden.preference_key(identified, [o for o in params.order if o.col in identified.columns])
    except TypeError:
        return False
    return all(o.col in identified.columns or o.col in ("confidence_rank", "confidence", "repetition")
               for o in params.order)


def gold_from_identified(identified: DataFrame, params: PipelineParams = PipelineParams(),
                         materialize: bool = False) -> GoldResult:
    return GoldResult(identified, params, materialize)


def identity_layers(bronze: DataFrame, params: PipelineParams = PipelineParams()) -> GoldResult:
    """The layers as lazy plans; identified records are materialized once
    (checkpoint) if the scoring join needs them in several branches."""
    return gold_from_identified(silver_identified(bronze, params), params, materialize=True)


def run_identity_job(spark: SparkSession, bronze: DataFrame, out_dir: str,
                     params: PipelineParams = PipelineParams(),
                     tables: Sequence[str] = ("gold_duplicate_count", "gold_confidence_scored", "gold_final")) -> dict[str, str]:
    """Batch job: each layer is written once as parquet and the next one reads
    it, so the source files are read once.

    Returns table name -> path. Every write is an overwrite of a whole table,
    so a rerun after a lost executor or a failed job produces the same files.
    """
    paths = {k: f"{out_dir.rstrip('/')}/{settings.TABLE_NAMES[k]}" for k in ("bronze", "silver_clean", "silver_identified", *tables)}

    def stored(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(paths[name])
        return spark.read.parquet(paths[name])

    clean = stored("silver_clean", silver_clean(stored("bronze", bronze), params))
    identified = stored("silver_identified", identity.with_identifier(clean, params.blank_as_null, params.priority, params.fallback))
    result = gold_from_identified(identified, params)
    frames = {"gold_duplicate_count": result.counts, "gold_confidence_scored": result.scored,
              "gold_final": result.golden}
    for t in tables:
        frames[t].write.mode("overwrite").parquet(paths[t])
    return paths
