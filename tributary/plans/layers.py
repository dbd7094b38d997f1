"""Bronze to Silver and Silver to Gold as chains of operators."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from tributary.config import GoldSpec, SilverSpec
from tributary.operators import (
    aggregate,
    clean,
    dedup,
    errors,
    gaps,
    incremental,
    joins,
    lineage,
    mapping,
    nested,
    partials,
    quality,
    type_plan,
    typing,
)
from tributary.session import materialize, scratch_path, storable
from tributary.sources import writers


def to_silver(
    bronze: DataFrame,
    spec: SilverSpec,
    meter: lineage.StageMeter | None = None,
    issues: Callable[[DataFrame], None] | None = None,
    types: str | None = None,
    run: str = "first",
) -> DataFrame:
    """Flatten, clean, normalize, convert types, resolve duplicates, handle gaps.

    Types are converted before dates are compared, so an epoch is never parsed
    as text. Before types are inferred, the cleaned rows are written once: the
    profile, the issues and the typed rows read that copy, and the code of
    either half stays short enough for the JVM to compile. Only types that hold
    every value are inferred. ``issues`` allows types that a tenth of a column
    does not fit, and is given those values. ``types`` names the folder of a
    stored plan: then only columns that no run has seen are profiled, values
    that do not fit stay in ``_untyped``, and ``type_plan.learn`` on the written
    rows widens the plan for the next run.
    """

    def watch(df: DataFrame, stage: str) -> DataFrame:
        return meter.watch(df, stage) if meter else df

    df = watch(nested.flatten(bronze, arrays=spec.arrays), "flatten")
    df = watch(clean.clean(df), "clean")
    df = watch(clean.normalize(df, spec.normalize), "normalize")
    df = typing.convert(df, spec.convert)
    if spec.infer:
        # Contacts are text whatever they look like: a phone number must not become a number.
        contacts = tuple(c for c, rule in spec.normalize.items() if rule["type"].startswith(("email", "phone")))
        fixed = tuple(spec.exclude) + contacts + tuple(spec.convert) + tuple(spec.keys)
        if storable(df):
            df = materialize(df, "silver-clean")
        if types:
            df = type_plan.typed(df, types, run, fixed)
        else:
            plan = typing.infer_types(df, 0.9 if issues else 1.0, fixed)
            if issues:
                issues(typing.misfits(df, plan, list(spec.keys)))
            df = typing.apply_types(df, plan)
    df = watch(df, "types")
    df = watch(dedup.resolve_conflicts(df, list(spec.keys), spec.order_column), "resolve")
    df = gaps.handle_gaps(df, list(spec.critical), dict(spec.defaults), spec.reject_incomplete)
    return watch(df, "gaps")


@dataclass
class Gold:
    """Checked rows of one run, before anything is published."""

    checked: DataFrame
    spec: GoldSpec
    as_of: Column
    meter: lineage.StageMeter | None = None

    @property
    def rows(self) -> DataFrame:
        """The accepted rows, as the recovery mode wants them."""
        out = errors.split_bad(self.checked, self.spec.recovery)
        return self.meter.watch(out, "split") if self.meter else out

    @property
    def dead_letters(self) -> DataFrame | None:
        return errors.dead_letters(self.checked, self.as_of) if self.spec.rules else None

    def staged(self, path: str | None = None) -> Gold:
        """The same rows written once, if enough of them are valid; ``quality.GateError`` otherwise.

        Rows and dead letters then read one copy instead of running the chain twice. A run that fails leaves the
        copy behind as evidence, and the error says where it is.
        """
        path = path or scratch_path(self.checked.sparkSession, "gold-audit")
        if self.spec.rules:
            kept = quality.audited(self.checked, self.spec.rules.threshold, path)
        else:
            kept = materialize(self.checked, path=path)
        return Gold(kept, self.spec, self.as_of, self.meter)


def to_gold(
    silver: DataFrame,
    spec: GoldSpec,
    as_of: Column,
    last_seen=None,
    dims: list[joins.Dimension] | None = None,
    meter: lineage.StageMeter | None = None,
    totals: str | None = None,
    run: str | None = None,
) -> Gold:
    """Incremental filter, map, calculate, aggregate, denormalize, check.

    The incremental filter comes first: it names a source column, so it prunes
    the scan. The caller advances the watermark after writing. An aggregate of
    an incremental run covers the new rows only, unless ``totals`` names the
    folder in which the runs' partial aggregates are kept; ``run`` names this
    one, and the result is the aggregate of all runs so far.
    """

    def watch(df: DataFrame, stage: str) -> DataFrame:
        return meter.watch(df, stage) if meter else df

    df = silver
    if spec.timestamp_column:
        df = incremental.since(df, spec.timestamp_column, last_seen)
    df = watch(df, "incremental")
    df = lineage.add_lineage(df, spec.pipeline_id, spec.source, as_of)
    df = watch(mapping.map_schema(df, list(spec.field_map)), "map")
    df = watch(mapping.calculate(df, dict(spec.formulas)), "calculate")
    if spec.aggregate and totals:
        if not run:
            raise ValueError("totals over runs need a name for this run")
        df = watch(partials.update(df, spec.aggregate, totals, run), "aggregate")
    elif spec.aggregate:
        df = watch(aggregate.aggregate(df, spec.aggregate), "aggregate")
    if dims:
        df = watch(joins.join_dims(df, dims), "denormalize")
    return Gold(quality.check(df, spec.rules), spec, as_of, meter)


def publish(gold: Gold, path: str, letters: str, run: str, by: list[str] | None = None, audit: str | None = None) -> DataFrame:
    """Write, audit, publish: Gold at ``path`` changes only if the run passes its gate.

    The rows are staged and judged first. Dead letters go to ``letters`` below the run's name, so a repeated run
    replaces its own; then the accepted rows replace the partitions ``by`` that they fill, or the table.
    """
    kept = gold.staged(audit)
    bad = kept.dead_letters
    if bad is not None:
        writers.write_dead_letters(bad, letters, run)
    if by:
        writers.overwrite_partitions(kept.rows, path, by)
    else:
        writers.full_replace(kept.rows, path)
    return kept.rows
