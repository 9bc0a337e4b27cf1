"""Feature views and historical retrieval over many views."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.asof import (
    DEFAULT_HOT_KEY_ROWS,
    _NO_TIMES,
    AsOfSource,
    _resolved,
    asof_join,
    cheap_to_reread,
    nested_asof_join,
    scan_stats,
    shared_keys,
)
from ..functions.contract import TypeContractError, check_types
from ..functions.timeutil import Micros, to_micros
from ..operators.latest import latest_by_key, rows_in_range
from ..sinks.save import shared_folder, written
from ..sources.entity import as_dataframe, check_entity_columns, column_named, entity_time_range, infer_entity_ts, quoted
from ..sources.source import Source
from .ondemand import OnDemandView, computed, resolve_on_demand


@dataclass(frozen=True)
class FeatureView:
    """Named features of one source, keyed by ``keys``, valid for ``ttl_seconds`` (0 = forever).

    ``source`` is a :class:`Source` or an already loaded DataFrame (then
    ``event_ts`` / ``created_ts`` name its time columns).  ``types`` declares
    feature types (``{"trips": "INT64"}``); a source that cannot carry them
    without loss is rejected when it is loaded, before any job, and other types
    that can are widened.
    """

    name: str
    keys: Sequence[str]
    features: Sequence[str]
    source: Source | DataFrame
    ttl_seconds: int = 0
    event_ts: str | None = None
    created_ts: str | None = None
    created_rule: str = "ordered"
    ties: str = "one"
    tie_break: Sequence[str] | None = None
    # a row answers only entity rows from its created time on (no later correction leaks back)
    created_as_of: bool = False
    types: Mapping[str, str] | None = None

    def load(self, spark: SparkSession) -> DataFrame:
        df = self.source.load(spark) if isinstance(self.source, Source) else self.source
        if not self.types:
            return df
        undeclared = [n for n in self.types if n not in self.features]
        if undeclared:
            raise TypeContractError(f"view {self.name!r}: types of unknown features: " + ", ".join(undeclared))
        cast = check_types(df, self.types, f"view {self.name!r}")
        return df.withColumns({n: F.col(quoted(n)).cast(t) for n, t in cast.items() if df.schema[n].dataType != t})

    @property
    def event_col(self) -> str:
        if self.event_ts:
            return self.event_ts
        if isinstance(self.source, Source):
            return self.source.event_ts
        return "event_timestamp"

    @property
    def created_col(self) -> str | None:
        if self.created_ts:
            return self.created_ts
        if isinstance(self.source, Source):
            return self.source.created_ts
        return None

    def pull_latest(self, spark: SparkSession, start=None, end=None) -> DataFrame:
        """Newest row per key with event time in [start, end] (L1), plus partition pruning."""
        df = self._pruned(spark, start, end)
        return latest_by_key(
            df, list(self.keys), list(self.features), self.event_col, self.created_col, start, end
        )

    def pull_all(self, spark: SparkSession, start=None, end=None) -> DataFrame:
        """Every row with event time in [start, end] (L2)."""
        df = self._pruned(spark, start, end)
        return rows_in_range(
            df, list(self.keys), list(self.features), self.event_col, start, end, self.created_col
        )

    def _pruned(self, spark, start, end) -> DataFrame:
        df = self.load(spark)
        if isinstance(self.source, Source):
            cond = self.source.partition_filter(start, end)
            if cond is not None:
                df = df.filter(cond)
        return df


def resolve_refs(views: Sequence[FeatureView], refs: Sequence[str]) -> list[tuple[FeatureView, list[str]]]:
    """``"view:feature"`` strings -> [(view, [features])] in request order (A1)."""
    by_name = {v.name: v for v in views}
    order: list[str] = []
    wanted: dict[str, list[str]] = {}
    for ref in refs:
        if ":" not in ref:
            raise ValueError(f"feature reference {ref!r} is not 'view:feature'")
        vname, feat = ref.split(":", 1)
        if vname not in by_name:
            raise ValueError(f"unknown feature view {vname!r} in {ref!r}")
        if feat not in by_name[vname].features:
            raise ValueError(f"unknown feature {feat!r} of view {vname!r}")
        if vname not in wanted:
            order.append(vname)
            wanted[vname] = []
        if feat not in wanted[vname]:
            wanted[vname].append(feat)
    return [(by_name[v], wanted[v]) for v in order]


def historical_features(
    spark: SparkSession,
    entity,
    views: Sequence[FeatureView],
    refs: Sequence[str] | None = None,
    *,
    entity_ts: str | None = None,
    full_feature_names: bool = False,
    transforms: dict | None = None,
    entity_bounds: tuple | None = None,
    hot_key_rows: int | None = DEFAULT_HOT_KEY_ROWS,
    snapshots: dict[str, str] | None = None,
    on_demand: Sequence[OnDemandView] = (),
) -> DataFrame:
    """Every entity row with the as-of value of each requested feature.

    ``entity`` is a DataFrame, SQL text or pandas frame.  Views that share a
    key set run in one scan (one shuffle).  Where one key set is part of all
    others (``[shop]`` and ``[shop, item]``), one shuffle by its keys serves the
    scans of all, unless too many rows share such a key (or
    ``hot_key_rows=None``: nothing is known).  Other key sets are folded, each
    scan carrying the entity row and the features found so far, while that row
    is hardly wider than a row number.  A wider entity is written once to the
    shared folder with a row number; each key set then scans keys, time and
    number alone (or, where most are repeated, the distinct keys and times),
    and the results meet the wide rows once, by the number.  The
    entity time range is read once and prunes every source.  ``transforms``
    ``{name: Column}`` are applied last (request-time computed features).
    The result is lazy.  ``entity_bounds=(lo, hi)`` (datetimes or text) gives
    the entity time range when the caller knows it.  It is checked against the
    data in the look that finds hot keys, and a range that is too narrow raises;
    with ``hot_key_rows=None`` nothing is read ahead and the range is trusted:
    entity rows outside of it may lose their matches.

    ``on_demand`` views compute features from others and from request columns of
    the entity table (see :class:`OnDemandView`); they are asked for by
    ``"view:feature"`` like any other, and what they need is joined with them.

    ``snapshots`` ``{view name: root}`` names folders of committed snapshots
    (:func:`materialize_incremental`) of views without TTL.  The newest one that
    ends before the first entity time then stands for all history up to its
    end; of the source only what it has not seen is read.
    """
    ent = as_dataframe(spark, entity, entity_ts)
    ets = infer_entity_ts(ent, entity_ts)
    if refs is None:
        refs = [f"{v.name}:{f}" for v in views for f in v.features]
        refs += [f"{v.name}:{f}" for v in on_demand for f in v.outputs]
    joined, plan = resolve_on_demand(views, on_demand, refs, ent)
    wanted = resolve_refs(views, joined)
    asked = set(refs)

    def out_name(view, feature):
        # what only on-demand views need travels under a name of its own
        if f"{view}:{feature}" not in asked:
            return f"__cj_in__{view}__{feature}"
        return f"{view}__{feature}" if full_feature_names else feature

    all_keys = []
    for v, _ in wanted:
        for k in v.keys:
            if k not in all_keys:
                all_keys.append(k)
    check_entity_columns(ent, all_keys, ets)

    ets_type = ent.schema[ets].dataType
    given = tuple(to_micros(spark, b, ets_type) for b in entity_bounds) if entity_bounds is not None else None
    groups: dict[tuple, list[AsOfSource]] = {}
    unknown = set(snapshots or ()) - {v.name for v in views}
    if unknown:
        raise ValueError("snapshots of unknown views: " + ", ".join(sorted(unknown)))
    if snapshots and given is None:
        found = entity_time_range(ent, ets)
        given = found if found[0] is not None else _NO_TIMES
    for v, feats in wanted:
        names = [out_name(v.name, f) for f in feats]
        src_df, indexed = v.load(spark), None
        if snapshots and v.name in snapshots:
            from ..streaming.refresh import snapshot_and_changes

            indexed = snapshot_and_changes(spark, v, snapshots[v.name], _first_in(given, ets_type, v, src_df))
            src_df = src_df if indexed is None else indexed
        # the same keys in another order are one scan
        groups.setdefault(tuple(sorted(v.keys, key=str.lower)), []).append(
            AsOfSource(
                df=src_df,
                event_ts=v.event_col,
                features=feats,
                names=names,
                ttl_seconds=v.ttl_seconds,
                created_ts=v.created_col,
                created_rule=v.created_rule,
                ties=v.ties,
                tie_break=v.tie_break,
                created_as_of=v.created_as_of,
                partition_prune=_partition_prune(v) if indexed is None else None,
            )
        )
    ready = [_resolved(ent, ets, keys, sources)[1:] for keys, sources in groups.items()]
    # hot keys and key lists of every key set, found on the original entity rows
    if hot_key_rows is not None or any(not keys for keys, _ in ready):
        by_row = len(ready) > 1 and shared_folder(spark) is not None and _is_wide(ent, ets, ready)
        row, ent_rows = _row_name(ent), None
        shared = shared_keys(ent, ets, ready) if hot_key_rows is not None else None
        if by_row and not (shared and _same_when_reread(ent)):  # read from its files, column by column, from now on
            ent_rows = _numbered(ent, row)
            ent = ent_rows.drop(row)
        look = scan_stats(spark, ent, ets, ready, hot_key_rows, given, shared=shared)
        if look.one_shuffle:
            by_row = False
        elif by_row and ent_rows is None:
            ent_rows = _numbered(ent, row)
        stats = [(look.bounds, h, few, tiers) for h, few, tiers in zip(look.hot, look.few_keys, look.tiers)]
        ready = [(keys, sources) for (keys, _), sources in zip(ready, look.sources)]
    else:
        bounds = given or entity_time_range(ent, ets)
        stats = [(bounds if bounds[1] is not None else _NO_TIMES, None, None, (False, False))] * len(ready)
        by_row, look = False, None
    if look is not None and look.one_shuffle:
        out = nested_asof_join(ent, ets, shared, ready, look.bounds, look.few_keys)
    elif by_row:
        out = ent_rows
        for (keys, sources), st, distinct in zip(ready, stats, look.distinct):
            out = out.join(_found_by_row(ent_rows, row, ets, keys, sources, st, distinct * 2 < look.rows), row)
    else:
        out = ent
        for (keys, sources), st in zip(ready, stats):
            out = asof_join(out, ets, keys, sources, stats=st)
    if plan:
        out = computed(out, plan, out_name)
        order = [out_name(*r.split(":", 1)) for r in dict.fromkeys(refs)]
        twice = [n for n in order if order.count(n) > 1 or column_named(ent, n)]
        if twice:
            raise ValueError(f"output columns {sorted(set(twice))} collide; use full feature names (view prefix) or rename")
    else:
        order = [out_name(v.name, f) for v, feats in wanted for f in feats]
    out = out.select(*[F.col(quoted(c)) for c in [*ent.columns, *order]])
    if transforms:
        out = out.withColumns(dict(transforms))
    return out


# an entity whose columns beside keys and time are wider is not carried through every scan
CARRIED_BYTES = 32


def _is_wide(ent: DataFrame, ets: str, groups) -> bool:
    """Whether the columns that no scan needs are wider than ``CARRIED_BYTES``, by their types' usual sizes."""
    needed = {ets, *(k for keys, _ in groups for k in keys)}
    sizes = ent._jdf.schema().fields()
    return sum(f.dataType().defaultSize() for f in sizes if f.name() not in needed) > CARRIED_BYTES


def _same_when_reread(ent: DataFrame) -> bool:
    """Whether the entity is cheap to read more than once, and the same rows each time."""
    return cheap_to_reread(ent) and ent._jdf.queryExecution().optimizedPlan().deterministic()


def _numbered(ent: DataFrame, row: str) -> DataFrame:
    """The entity written once to the shared folder, with a row number."""
    return written(ent.withColumn(row, F.monotonically_increasing_id()), "entity")[0]


def _row_name(ent: DataFrame) -> str:
    name = "entity_row"
    while column_named(ent, name):
        name += "_"
    return name


def _found_by_row(ent_rows: DataFrame, row: str, ets: str, keys, sources, stats, repeated: bool) -> DataFrame:
    """(row number, features) of every entity row for one key set; several rows where ties are all wanted."""
    names = [F.col(quoted(n)) for s in sources for n in s.out_names()]
    on = [*keys, ets]
    narrow = ent_rows.select(*[F.col(quoted(c)) for c in on], row)
    if not repeated:
        return asof_join(narrow, ets, keys, sources, stats=stats).select(row, *names)
    # rows without a key or time find nothing, here as there
    found = asof_join(narrow.drop(row).dropna().distinct(), ets, keys, sources, stats=stats)
    return narrow.join(found, on, "left").select(row, *names)


def _first_in(bounds, ets_type, view: FeatureView, df: DataFrame) -> Micros:
    """The first entity time in the source's terms; a day earlier where its timestamp type is another one."""
    own = df.schema[column_named(df, view.event_col)].dataType
    return Micros(bounds[0] - (0 if own == ets_type else 86_400_000_000))


def _partition_prune(view: FeatureView):
    """bounds -> filter on the source's date partition column covering [min - ttl, max], or None.

    Directory partitions outside the window are then never listed or read.
    """
    if not (isinstance(view.source, Source) and view.source.partition_col):
        return None

    def prune(bounds):
        lo = None
        if view.ttl_seconds and bounds[0] is not None:
            lo = Micros(bounds[0] - view.ttl_seconds * 1_000_000)
        return view.source.partition_filter(lo, bounds[1])

    return prune
