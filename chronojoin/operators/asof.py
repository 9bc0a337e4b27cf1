"""Point-in-time (as-of) join by union-scan.

For every entity row ``(keys, t)`` and every feature view, find the source
row with equal keys and the greatest event time ``<= t`` (created time and
then the feature values break ties), and keep it only if it is not older
than ``t - ttl``.

Plan (one shuffle for all views that share a key set):

1. Source rows become ``(keys, _t = event_ts, _side = 0, _f<i> = struct(event_ts,
   created_ts, features...))``; entity rows become ``(keys, _t = entity_ts,
   _side = 1, _e = struct(other entity columns))``.
2. The union is sorted within ``Window.partitionBy(keys[, _b])`` by ``_t``
   and ``max(_f<i>)`` over the RANGE frame up to the current row (peers
   included: upper bound inclusive) gives, at each entity row, the source
   row at or before it with the greatest (event time, created time,
   features): the newest, ties broken.  If that row fails the TTL every
   older one does too.
3. Entity rows are kept, features pulled out of the struct.  Carrying the
   whole entity row through the scan keeps duplicates and avoids a join back.
   Every entity row takes the same single path (no second read of the
   entity, which in a fold would re-run the previous scan).

Key sets that all contain the smallest one share that one's shuffle: see
:func:`nested_asof_join`.

Hot keys.  A window partition is one task, so a key holding a third of the
data would be one task.  Before the scan a small sample of entity and source
rows (about ``HOT_SAMPLE_ROWS`` rows of a key at the threshold) estimates each
key's rows and time quantiles; the list of keys above ``hot_key_rows`` stays a
DataFrame.  Each such key gets time buckets ``_b`` with the quantiles as edges,
so bunched history and outliers give buckets of about equal size (rows of one
equal time stay together).  The window then partitions by ``(keys, _b)``.  To
each (key, bucket) a *carry row* — the greatest source row of all earlier
buckets — is added at the head of the bucket, so the scan stays exact whatever
the estimate.  Where such a key is small beside a task's share of the rows all its
buckets go to one task in one shuffle, and what is carried is a window over them
there, without rows of its own (:func:`_bucketed`).  The source alone gives them: the entity, in a fold the previous
scan, is not read for them.  Carry rows come from a per-bucket top-1 (partial
``WindowGroupLimit`` before the shuffle) and a small window over buckets.  A
view without keys is one key and always split.  Keys below the threshold keep
one bucket.  Entity rows with a NULL key or time match nothing and are dealt
into buckets of their own by a hash.

Source reduction.  Where the entity has few distinct keys (their list is below
the session's broadcast threshold by a measured size) source rows of other keys
are dropped by a broadcast semi join before the shuffle.  With more keys, and a
source that has over twice as many, a bitmap of hashed keys below the same
threshold keeps out most rows that no entity row asks for (:func:`_key_bitmap`).
Of a source that is cheap to read in parts, without TTL, only one row per key is
kept from before the first entity time, by a partial top-1.

Derived sources.  A source made by a join, an aggregation or the like is
computed once where the session names a shared folder (``spark.checkpoint.dir``):
its rows in range, in the columns the scan needs, are written there and read
back by the look ahead and by every scan.  How many rows and keys it has is
gathered while it is written, and where a scan cannot have a key with more than
``hot_key_rows`` rows nothing else is looked at.

Created-time rules:

* ``"ordered"`` (default): order by (event time, created time NULLs first);
  the newest event wins, the newest created breaks ties.
* ``"independent_max"``: reproduces the historical behaviour that takes the
  greatest event time and the greatest created time of the candidates
  independently and keeps a value only if one row has both.  Rows with a
  NULL created time never match.  With a TTL the greatest created time
  over ``[t - ttl, t]`` comes from running maxima over tumbling ``ttl``-wide
  stretches, read by the entity row and by a probe at ``t - ttl``: within the
  scan's own partitions, without a further shuffle or join.  Where buckets of a
  key are dealt to different tasks a row and its probe may lie apart; then it is a scan of its own
  (see :func:`_range_created_max`), joined back on (keys, t).

``created_as_of`` (two times): a source row counts only from when it was known,
so a correction that was created after the entity time does not answer it.
Source rows enter the scan at *visible-from* = the greater of event and created
time, and the running maximum is still over (event time, created time,
features): the newest event among the rows known by then.  If that row fails
the TTL so does every other one.  A row whose created time is NULL was known at
no certain time and never matches.  Only with the ``"ordered"`` rule.

Ties: ``"one"`` returns one row per entity row (deterministic: greatest
created, then greatest feature values); ``"all"`` returns every source row
tied on (event time, created time), through an equi-join back on
``(keys, event time)`` after the scan.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field, replace
from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timeutil import Micros, epoch_micros, is_time_type, seconds_interval, time_literal, to_micros
from ..functions.types import is_orderable
from ..sinks.save import shared_dir, shared_folder, written
from ..sources.entity import column_named, entity_time_range, quoted

# Internal column names; entity tables may not use the prefix.
_P = "__cj_"
_T, _TU, _SIDE, _B, _E = _P + "t", _P + "tu", _P + "side", _P + "b", _P + "e"
_F_TS, _F_C = _P + "ts", _P + "c"
_G, _H = _P + "g", _P + "h"
_J, _APART = _P + "j", _P + "apart"

_AUTO = "auto"

log = logging.getLogger("chronojoin")

DEFAULT_HOT_KEY_ROWS = 2_000_000
# an entity table without any time: a range that no row is in
_NO_TIMES = (Micros(0), Micros(-62_135_596_800_000_000))


def _c(name: str) -> Column:
    """The column of that very name."""
    return F.col(quoted(name))


@dataclass(frozen=True)
class AsOfSource:
    """One feature source for the scan: a loaded DataFrame and how to read it."""

    df: DataFrame
    event_ts: str
    features: Sequence[str]
    names: Sequence[str] | None = None  # output names, default = features
    ttl_seconds: int = 0
    created_ts: str | None = None
    created_rule: str = "ordered"
    ties: str = "one"
    tie_break: Sequence[str] | None = None
    created_as_of: bool = False  # rows count from their created time on only
    key_map: dict | None = field(default=None)  # entity key -> source column
    # cheap to read more than once (tables or files, projected and filtered); None: found out from its plan
    reread: bool | None = None
    # bounds -> extra literal filter (e.g. on a date partition column), or None
    partition_prune: object | None = None

    def out_names(self) -> list[str]:
        return list(self.names) if self.names is not None else list(self.features)


def point_in_time_join(
    entity: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    entity_ts: str,
    event_ts: str,
    *,
    ttl_seconds: int = 0,
    created_ts: str | None = None,
    ties: str = "one",
    tie_break: Sequence[str] | None = None,
    created_rule: str = "ordered",
    created_as_of: bool = False,
    prefix: str | None = None,
    prune: bool = True,
    hot_key_rows: int | None = DEFAULT_HOT_KEY_ROWS,
) -> DataFrame:
    """As-of join of one source onto every entity row; see module doc.

    ``prefix`` names the features ``prefix + feature``.  ``prune`` reads the
    entity time range once (one small job) and filters the source to
    ``[min - ttl, max]`` with literals that reach the scan.
    ``hot_key_rows=None`` turns hot-key detection off (a view without keys is
    split all the same).
    """
    names = [f"{prefix}{f}" for f in features] if prefix else list(features)
    src = AsOfSource(
        df=source,
        event_ts=event_ts,
        features=list(features),
        names=names,
        ttl_seconds=ttl_seconds,
        created_ts=created_ts,
        created_rule=created_rule,
        ties=ties,
        tie_break=tie_break,
        created_as_of=created_as_of,
    )
    return asof_join(entity, entity_ts, keys, [src], prune=prune, hot_key_rows=hot_key_rows)


# ---------------------------------------------------------------------------
def _key_type(name: str, a: T.DataType, b: T.DataType) -> T.DataType:
    """The type in which entity and source keys are compared; raises where they cannot be."""
    for kinds in ((T.ByteType, T.ShortType, T.IntegerType, T.LongType), (T.FloatType, T.DoubleType)):
        if type(a) in kinds and type(b) in kinds:
            return max(a, b, key=lambda t: kinds.index(type(t)))
    if type(a) is type(b) and (not isinstance(a, T.DecimalType) or a == b):
        return a
    raise ValueError(
        f"key {name!r} has type {a.simpleString()} in the entity table and {b.simpleString()} in the source; cast one of them"
    )


def _resolved(entity: DataFrame, entity_ts: str, keys, sources):
    """Names as the tables have them (Spark ignores letter case by default): entity time, keys, sources."""

    def named(df, name, what):
        found = column_named(df, name)
        if found is None:
            raise ValueError(f"{what}: {name}")
        return found

    ets = named(entity, entity_ts, "entity timestamp column not in entity table")
    ks = [named(entity, k, "entity table lacks key columns") for k in keys]
    out = []
    for s in sources:
        km = {e: named(s.df, (s.key_map or {}).get(k, k), "source lacks columns") for e, k in zip(ks, keys)}
        one = {n: named(s.df, n, "source lacks columns") for n in [s.event_ts, *s.features, *(s.tie_break or [])]}
        out.append(
            replace(
                s,
                event_ts=one[s.event_ts],
                created_ts=named(s.df, s.created_ts, "source lacks columns") if s.created_ts else None,
                names=s.out_names(),
                features=[one[f] for f in s.features],
                tie_break=[one[f] for f in s.tie_break] if s.tie_break else None,
                key_map=km,
            )
        )
    return ets, ks, out


def _check(entity: DataFrame, entity_ts: str, keys: Sequence[str], sources: Sequence[AsOfSource]) -> dict:
    """Raise on what cannot run; the types in which keys are compared."""
    bad = [c for c in entity.columns if c.startswith(_P)]
    if bad:
        raise ValueError(f"entity columns may not start with {_P!r}: {bad}")
    if not is_time_type(entity.schema[entity_ts].dataType):
        raise ValueError(f"entity timestamp column {entity_ts!r} is not a timestamp")
    fold = str if entity.sparkSession.conf.get("spark.sql.caseSensitive") == "true" else str.lower
    seen = {fold(c) for c in entity.columns}
    types = {k: entity.schema[k].dataType for k in keys}
    for s in sources:
        if s.created_rule not in ("ordered", "independent_max"):
            raise ValueError(f"created_rule must be 'ordered' or 'independent_max', not {s.created_rule!r}")
        if s.ties not in ("one", "all"):
            raise ValueError(f"ties must be 'one' or 'all', not {s.ties!r}")
        if s.ttl_seconds < 0:
            raise ValueError("ttl_seconds must be >= 0")
        if s.created_as_of and not s.created_ts:
            raise ValueError("created_as_of needs a created time column")
        if s.created_as_of and s.created_rule != "ordered":
            raise ValueError("created_as_of goes with created_rule 'ordered' only")
        if s.created_as_of and not is_time_type(s.df.schema[s.created_ts].dataType):
            raise ValueError(f"source created time {s.created_ts!r} is not a timestamp")
        if not is_time_type(s.df.schema[s.event_ts].dataType):
            raise ValueError(f"source event time {s.event_ts!r} is not a timestamp")
        for k in keys:
            types[k] = _key_type(k, types[k], s.df.schema[s.key_map[k]].dataType)
        for n in s.out_names():
            if fold(n) in seen:
                raise ValueError(
                    f"output column {n!r} collides with an entity column or another feature; "
                    "use full feature names (view prefix) or rename"
                )
            seen.add(fold(n))
    return types


def _in_range(s: AsOfSource, ets_type, bounds) -> tuple[Column, Column]:
    """(event time in the entity's type, filter to [min - ttl, max] of the entity times).

    Bounds are literals on the stored column, so they reach the scan.  A column
    of the other timestamp type gets a literal filter a day wider on either side
    (the types differ by the session's zone) besides the exact one.
    """
    raw = _c(s.event_ts)
    own = s.df.schema[s.event_ts].dataType
    ts = raw if own == ets_type else raw.cast(ets_type)
    cond = raw.isNotNull()
    lo, hi = bounds
    if hi is not None:
        lo = Micros(lo - s.ttl_seconds * 1_000_000)
        day = 0 if own == ets_type else 86_400_000_000
        cond = cond & (raw <= time_literal(Micros(hi + day), own))
        if s.ttl_seconds > 0:
            cond = cond & (raw >= time_literal(Micros(lo - day), own))
        if day:
            cond = cond & (ts <= time_literal(hi, ets_type))
            if s.ttl_seconds > 0:
                cond = cond & (ts >= time_literal(lo, ets_type))
        if s.created_as_of:
            made = s.df.schema[s.created_ts].dataType
            wider = 0 if made == ets_type else 86_400_000_000
            cond = cond & (_c(s.created_ts) <= time_literal(Micros(hi + wider), made))
        if s.partition_prune is not None:
            cond = cond & s.partition_prune(bounds)
    return ts, cond


def _visible_from(s: AsOfSource, ts: Column, ets_type) -> Column:
    """When a source row starts to count: its event time, or with ``created_as_of`` once it was created too."""
    return F.greatest(ts, _c(s.created_ts).cast(ets_type)) if s.created_as_of else ts


def _source_rows(s: AsOfSource, i: int, keys, types, ets_type, bounds, few_keys=None) -> DataFrame:
    """Source rows of view ``i`` in scan form (step 1); ``few_keys``: a small table of the entity's keys."""
    df = s.df
    ts, cond = _in_range(s, ets_type, bounds)
    for k in keys:
        cond = cond & _c(s.key_map[k]).isNotNull()
    if s.created_as_of or (s.created_rule == "independent_max" and s.created_ts):
        cond = cond & _c(s.created_ts).isNotNull()
    created = _c(s.created_ts) if s.created_ts else F.lit(None).cast(ets_type)
    payload = [ts.alias(_F_TS), created.alias(_F_C)]
    payload += [_c(f).alias(n) for f, n in zip(s.features, s.out_names())]
    rows = df.filter(cond).select(
        *[_c(s.key_map[k]).cast(types[k]).alias(k) for k in keys],
        _visible_from(s, ts, ets_type).alias(_T),
        F.lit(0).alias(_SIDE),
        F.struct(*payload).alias(f"{_P}f{i}"),
    )
    if isinstance(few_keys, _Bitmap):
        rows = few_keys.may_have(rows, keys)
    elif few_keys is not None:
        rows = rows.join(F.broadcast(few_keys), list(keys), "left_semi")  # a measured size, see scan_stats
    return rows


# plan nodes that read no row twice and move none: a plan of these alone is as cheap to run again as its scan
_CHEAP = {"Project", "Filter", "SubqueryAlias", "View", "LogicalRelation", "Relation", "LocalRelation", "LogicalRDD",
          "Union", "HiveTableRelation", "DataSourceV2Relation", "DataSourceV2ScanRelation", "Range", "ResolvedHint"}


def cheap_to_reread(df: DataFrame) -> bool:
    """Whether the plan of ``df`` is projections and filters over scans, also behind a view's name."""
    todo = [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().split(" ")[0] not in _CHEAP:
            return False
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return True


def _rereadable(s: AsOfSource) -> bool:
    return cheap_to_reread(s.df) if s.reread is None else s.reread


def _store_once(s: AsOfSource, keys, types, ets_type, bounds, few) -> tuple[AsOfSource, int, int]:
    """A derived source computed once: (the source read from the shared folder, its rows, about its distinct keys)."""
    _, cond = _in_range(s, ets_type, bounds)
    for k in keys:
        cond = cond & _c(s.key_map[k]).isNotNull()
    wanted = [*s.key_map.values(), s.event_ts, *([s.created_ts] if s.created_ts else []), *s.features, *(s.tie_break or [])]
    rows = s.df.filter(cond).select(*[_c(c) for c in dict.fromkeys(wanted)])
    if few is not None:
        own = few.select(*[_c(k).alias(f"{_P}k{n}") for n, k in enumerate(keys)])
        on = [_c(s.key_map[k]).cast(types[k]) == F.col(f"{_P}k{n}") for n, k in enumerate(keys)]
        rows = rows.join(F.broadcast(own), on, "left_semi")
    seen = Observation("derived source")
    kept, counts = written(
        rows, "source", seen, F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(_source_hash(s, keys, types), 0.05).alias("keys")
    )
    return replace(s, df=kept, reread=True, partition_prune=None), counts["rows"], counts["keys"]


def _source_hash(s: AsOfSource, keys, types) -> Column:
    return F.xxhash64(*[_c(s.key_map[k]).cast(types[k]) for k in keys]) if keys else F.lit(0).cast("long")


@dataclass(frozen=True)
class _Bitmap:
    """Hashed keys as a table of ``_WORDS`` longs a row: a row for each stretch of slots that holds a key."""

    table: DataFrame
    slots: int

    def may_have(self, rows: DataFrame, keys) -> DataFrame:
        """``rows`` without those whose keys are surely not in the bitmap."""
        slot = F.pmod(_key_hash(keys), F.lit(self.slots))
        bit = _one_bit(slot)
        word = F.pmod(F.shiftright(slot, 6), F.lit(_WORDS)).cast("int")
        hit = F.get(F.col(_P + "words"), word).bitwiseAND(bit) != 0
        on = rows.withColumn(_P + "row", F.shiftright(slot, _ROW_BITS))
        # at most slots / 8 bytes, checked against the broadcast threshold by scan_stats
        return on.join(F.broadcast(self.table), _P + "row").filter(hit).drop(_P + "row", _P + "words")


_WORDS = 512
_ROW_BITS = 15  # log2(64 * _WORDS)
_SLOTS_PER_KEY = 8


def _one_bit(slot: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(slot, F.lit(64)).cast("int"))


def _key_bitmap(entity: DataFrame, keys, types, slots: int) -> _Bitmap:
    """The entity's keys in ``slots`` hash slots (a power of two), by JVM aggregates; eight slots a key let one in eight others pass."""
    key = [_c(k).cast(types[k]).alias(k) for k in keys]
    slot = F.pmod(_key_hash(keys), F.lit(slots))
    some = entity.select(*key).filter(" and ".join(f"{quoted(k)} is not null" for k in keys)).select(slot.alias("s"))
    words = some.groupBy(F.shiftright("s", _ROW_BITS).alias(_P + "row"), F.pmod(F.shiftright("s", 6), F.lit(_WORDS)).cast("int").alias("w")).agg(
        F.bit_or(_one_bit(F.col("s"))).alias("b")
    )
    rows = words.groupBy(_P + "row").agg(F.map_from_entries(F.collect_list(F.struct("w", "b"))).alias("m"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(_WORDS - 1)), lambda w: F.coalesce(F.col("m")[w], F.lit(0).cast("long")))
    return _Bitmap(rows.select(_P + "row", dense.alias(_P + "words")), slots)


def _without_old_history(rows: DataFrame, s: AsOfSource, i: int, keys, ets_type, bounds) -> DataFrame:
    """Scan rows of a view without TTL, with one row per key before the first entity time.

    No older row of a key can win.  The top-1 is planned as a partial limit per
    key before its shuffle.  With ``independent_max`` the row created last stays
    as well, for the greatest created time.
    """
    if not (_rereadable(s) and keys and s.ttl_seconds == 0 and bounds[0] is not None):
        return rows
    first = time_literal(bounds[0], ets_type)
    old = rows.filter(F.col(_T) < first)
    payload = F.col(f"{_P}f{i}")
    order = _order_key(s, i, rows.schema)
    order = payload if order is None else order
    rn = f"{_P}rn"

    def top(*by):
        w = Window.partitionBy(*[_c(k) for k in keys]).orderBy(*by)
        return old.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)

    out = rows.filter(F.col(_T) >= first).unionByName(top(payload[_F_TS].desc(), order.desc_nulls_last()))
    if s.created_rule == "independent_max" and s.created_ts:
        out = out.unionByName(top(payload[_F_C].desc_nulls_last()))
    return out


def _order_key(s: AsOfSource, i: int, schema: T.StructType, f: Column | None = None) -> Column | None:
    """Sort key of view ``i``'s rows among equal times: created, then tie-break / features.

    None when the payload struct itself sorts that way (all features orderable,
    no explicit tie-break).  ``f``: the payload, where it is not the scan's own.
    """
    f = F.col(f"{_P}f{i}") if f is None else f
    names = s.out_names()
    if s.tie_break:
        fmap = dict(zip(s.features, names))
        extra = [fmap.get(c, c) for c in s.tie_break]
        missing = [c for c in extra if c not in names]
        if missing:
            raise ValueError("tie_break columns must be features of the view: " + ", ".join(missing))
    else:
        extra = names
    fields = schema[f"{_P}f{i}"].dataType
    extra = [c for c in extra if is_orderable(fields[c].dataType)]
    if extra == names and is_orderable(fields):
        return None  # the payload itself sorts as (ts, created, features...)
    return F.struct(f[_F_C].alias("c"), *[f[c].alias(c) for c in extra])


def _floor_div(x: Column, w: int) -> Column:
    """floor(x / w) for longs, exact (also below zero)."""
    return ((x - F.pmod(x, F.lit(w))) / F.lit(w)).cast("long")


def _range_created_max(entity, entity_ts, keys, types, s, i, ets_type, bounds, hot, few) -> DataFrame:
    """Greatest created time over source rows in ``[t - ttl, t]``, per distinct (keys, t).

    Streaming form of a sliding maximum.  With tumbling stretches of width
    ``ttl``, ``[t - ttl, t]`` is the part of stretch(t) up to ``t`` plus the
    part of the stretch before it from ``t - ttl`` on.  Stretches of hot keys
    are cut into cells by the key's time buckets.  One shuffle by (keys,
    stretch, bucket): an ascending running max read by a probe at ``t``, a
    descending one read by a probe at ``t - ttl`` (RANGE frames: equal times
    included); the cells between the probe's and the end of its stretch come
    from a running max over cell maxima.  Both halves are then combined per
    (keys, t).  No sliding frame, so no frame buffer is re-read.
    """
    width = s.ttl_seconds * 1_000_000
    f = F.col(f"{_P}f{i}")
    c_type = s.df.schema[s.created_ts].dataType
    ks = [_c(k) for k in keys]
    none_t = F.lit(None).cast(ets_type).alias("t0")
    src = _source_rows(s, i, keys, types, ets_type, bounds, few).select(
        *ks, F.col(_T), f[_F_C].alias("c"), F.lit(0).alias("p"), none_t
    )
    valid = _c(entity_ts).isNotNull()
    for k in keys:
        valid = valid & _c(k).isNotNull()
    d = entity.filter(valid).select(*[_c(k).cast(types[k]).alias(k) for k in keys], _c(entity_ts).alias("t0"))
    none_c = F.lit(None).cast(c_type).alias("c")
    # both probes from one read; equal ones meet in the last aggregation
    probes = d.select(*ks, "t0", F.explode(F.array(F.lit(1), F.lit(2))).alias("p"))
    at = F.when(F.col("p") == 1, F.col("t0")).otherwise(F.col("t0") - seconds_interval(s.ttl_seconds))
    u = src.unionByName(probes.select(*ks, at.alias(_T), none_c, "p", "t0"))
    u = u.withColumn(_TU, epoch_micros(F.col(_T), ets_type)).withColumn("b", _floor_div(F.col(_TU), width))
    if hot is None:
        u = u.withColumn(_B, F.lit(0).cast("long"))
    else:
        u = u.withColumn(_H, _key_hash(keys)).join(hot, on=_H, how="left")
        u = u.withColumn(_B, F.when(F.col(_P + "edges").isNull(), F.lit(0).cast("long")).otherwise(_bucket_of(F.col(_TU))))
    cell = [*ks, F.col("b"), F.col(_B)]
    up = Window.partitionBy(*cell).orderBy(F.col(_T).asc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy(*cell).orderBy(F.col(_T).desc()).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    v = u.select(
        *ks, "b", _B, "t0", "p", F.max("c").over(up).alias("a"), F.max("c").over(down).alias("z")
    ).filter(F.col("p") != 0)
    v = v.withColumn("m", F.when(F.col("p") == 1, F.col("a")).otherwise(F.col("z")))
    if hot is not None:
        stretch = Window.partitionBy(*ks, F.col("b")).orderBy(_B)
        before = stretch.rowsBetween(Window.unboundedPreceding, -1)
        after = stretch.rowsBetween(1, Window.unboundedFollowing)
        cells = (
            u.filter(F.col(_P + "edges").isNotNull())
            .groupBy(*ks, "b", _B)
            .agg(F.max("c").alias("c"))
            .select(*ks, "b", _B, F.max("c").over(before).alias("lo"), F.max("c").over(after).alias("hi"))
        )
        v = v.join(cells, [*keys, "b", _B], "left")
        v = v.withColumn("m", F.greatest("m", F.when(F.col("p") == 1, F.col("lo")).otherwise(F.col("hi"))))
    out = v.groupBy(*ks, "t0").agg(F.max("m").alias(f"{_P}m{i}"))
    return out.select(
        *[_c(k).cast(entity.schema[k].dataType).alias(k) for k in keys], F.col("t0").alias(entity_ts), f"{_P}m{i}"
    )


_T0 = _P + "t0"


def _with_probes(u0: DataFrame, keys, sources, fused) -> DataFrame:
    """Scan rows with a probe at ``t - ttl`` for each entity row that can match and each view of ``fused``."""
    asks = (F.col(_SIDE) == 1) & F.col(_T).isNotNull()
    for k in keys:
        asks = asks & _c(k).isNotNull()
    # from the same read of the entity, which in a fold is the previous scan
    sides = F.when(asks, F.array(F.lit(1), *[F.lit(2 + i) for i in fused])).otherwise(F.array(F.col(_SIDE)))
    u = u0.withColumn(_SIDE, F.explode(sides))
    at = F.col(_T)
    for i in fused:
        at = F.when(F.col(_SIDE) == 2 + i, F.col(_T) - seconds_interval(sources[i].ttl_seconds)).otherwise(at)
    return u.withColumns({_T: at, _E: F.when(F.col(_SIDE) < 2, F.col(_E))})


def _asked(u: DataFrame, sources, fused, ets_type) -> DataFrame:
    """``_t0``, the entity time a row asks for, and ``_w<i>``, the stretch of width ttl a row lies in."""
    if not fused:
        return u
    t0 = F.when(F.col(_SIDE) == 1, F.col(_T))
    for i in fused:
        t0 = F.when(F.col(_SIDE) == 2 + i, F.col(_T) + seconds_interval(sources[i].ttl_seconds)).otherwise(t0)
    us = epoch_micros(F.col(_T), ets_type)
    return u.withColumns({_T0: t0, **{f"{_P}w{i}": _floor_div(us, sources[i].ttl_seconds * 1_000_000) for i in fused}})


def _window_maxima(sources, fused, part) -> list:
    """For each view of ``fused``: the greatest created time of its stretch up to an entity row, or from a probe on.

    ``[t - ttl, t]`` is the part of stretch(t) up to ``t`` plus the part of the
    stretch before it from ``t - ttl`` on, see :func:`_range_created_max`.
    """
    out = [F.col(_T0)] if fused else []
    for i in fused:
        cell = Window.partitionBy(*[_c(c) for c in part], F.col(f"{_P}w{i}"))
        c = F.col(f"{_P}f{i}")[_F_C]
        up, down = (cell.orderBy(o).rangeBetween(Window.unboundedPreceding, Window.currentRow) for o in (F.col(_T).asc_nulls_first(), F.col(_T).desc()))
        out.append(F.when(F.col(_SIDE) == 1, F.max(c).over(up)).when(F.col(_SIDE) == 2 + i, F.max(c).over(down)).alias(f"{_P}h{i}"))
    return out


def _maxima_at_entities(scanned: DataFrame, fused, part) -> DataFrame:
    """``_m<i>`` on entity rows: the greater of their own half and their probe's, which share keys and entity time."""
    if not fused:
        return scanned
    one = Window.partitionBy(*[_c(c) for c in part], F.col(_T0))
    asked = scanned.filter(F.col(_SIDE) >= 1)
    return asked.withColumns({f"{_P}m{i}": F.max(f"{_P}h{i}").over(one) for i in fused})


def _greatest_payload(f: Column, order: Column | None) -> Column:
    """Aggregate picking the payload with the greatest (event time, order key)."""
    if order is None:
        return F.max(f)
    return F.max_by(f, F.when(f.isNotNull(), F.struct(f[_F_TS].alias("t"), order.alias("o"))))


def _greater_payload(a: Column, b: Column, key) -> Column:
    """The payload with the greatest (event time, order key) of two, either of which may be NULL; ``key``: payload -> order key."""
    if key(a) is None:
        return F.greatest(a, b)
    of = [F.struct(f[_F_TS].alias("t"), key(f).alias("o")) for f in (a, b)]
    return F.when(b.isNull() | (of[0] >= of[1]), a).otherwise(b)


def _key_hash(keys) -> Column:
    """64-bit hash of the key columns (a constant for a view without keys)."""
    return F.xxhash64(*[_c(k) for k in keys]) if keys else F.lit(0).cast("long")


# Expected sampled rows of a key right at the threshold; the count of such a
# key is then estimated within about a tenth.
HOT_SAMPLE_ROWS = 100
# Time quantiles that are estimated for each hot key: the most buckets it gets.
QUANTILES = 1 << 12
# Sampled rows of a key up to which its quantiles are read off the sorted sample.
SORTED_ROWS = 100_000
# Keys with one such part of a task's share of the rows, or more, would make tasks uneven: their buckets are dealt apart.
PARTS_OF_A_SHARE = 4
_GRID = ", ".join(f"{q / QUANTILES!r}D" for q in range(1, QUANTILES))


@dataclass(frozen=True)
class ScanStats:
    """What one look at the data before the scans found."""

    bounds: tuple  # entity time range
    hot: list  # for each scan: table (hash, edges, steps of a search in them) of keys to split, or None
    few_keys: list  # for each scan: small table of the entity's distinct keys, or a bitmap of them, or None
    sources: list  # for each scan: its sources, derived ones read back from the shared folder
    rows: int  # entity rows
    distinct: list  # for each scan: about how many different (keys, time) the entity has
    one_shuffle: bool = False  # dealt by the shared keys no task gets too much, see nested_asof_join
    tiers: list = field(default_factory=list)  # for each scan: (whether keys are dealt apart, whether keys are split in their task)


_FEW_ROWS = 1_000


def _kept(df: DataFrame) -> DataFrame:
    """``df`` computed once: sampled estimates must not change when a lost executor makes Spark read them again.

    A few rows pass through the driver, more stay in the shared folder; a
    session that names none is told to.
    """
    spark = df.sparkSession
    if shared_folder(spark):
        files, seen = written(df, "hot-keys", Observation("hot keys"), F.count(F.lit(1)).alias("rows"))
        return files if seen["rows"] > _FEW_ROWS else spark.createDataFrame(files.collect(), df.schema)
    rows = df.limit(_FEW_ROWS + 1).collect()
    if len(rows) > _FEW_ROWS:
        shared_dir(spark)  # raises: there is none
    return spark.createDataFrame(rows, df.schema)


def _hot_keys(entity, entity_ts, groups, types, hot_key_rows: int | None, bounds, most: list) -> tuple[list, list]:
    """(table, tiers) of the keys to split of each scan (None: no such key); ``most``: rows of each scan where known, else None.

    Keys that have a quarter of a task's share of all rows of such keys, or more,
    are marked (``_APART``): their buckets go to different tasks.
    """
    spark = entity.sparkSession
    ets_type = entity.schema[entity_ts].dataType
    wanted = [
        g
        for g, (keys, _) in enumerate(groups)
        if not keys or (hot_key_rows is not None and (most[g] is None or most[g] > hot_key_rows))
    ]
    none = [None] * len(groups), [(False, False)] * len(groups)
    if not wanted:
        return none
    rows = float(hot_key_rows or DEFAULT_HOT_KEY_ROWS)
    parts = []
    for g in wanted:
        keys, sources = groups[g]
        # without keys there is one group, which partial aggregation counts in full
        rate = min(1.0, HOT_SAMPLE_ROWS / rows) if keys else 1.0
        es = entity.select(*[_c(k).cast(types[g][k]).alias(k) for k in keys], _c(entity_ts).alias(_T))
        for u in [es, *[_source_rows(s, i, keys, types[g], ets_type, bounds) for i, s in enumerate(sources)]]:
            u = u.filter(F.col(_T).isNotNull())
            u = u.sample(withReplacement=False, fraction=rate, seed=7) if rate < 1.0 else u
            parts.append(
                u.select(
                    F.lit(g).alias(_G), _key_hash(keys).alias(_H), epoch_micros(F.col(_T), ets_type).alias(_TU), F.lit(1.0 / rate).alias("w")
                )
            )
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    keyless = [g for g in wanted if not groups[g][0]]
    n_b = F.ceil(F.col("n") / F.lit(rows))
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if keyless:
        n_b = F.when(F.col(_G).isin(keyless), F.greatest(n_b, F.lit(spread))).otherwise(n_b)
    counted = u.groupBy(_G, _H).agg(F.sum("w").cast("long").alias("n"), F.count(F.lit(1)).alias("s"))
    found = counted.withColumn("nb", F.least(n_b, F.lit(QUANTILES)).cast("int")).filter(F.col("nb") > 1)
    found = _kept(found)
    share = F.lit(None).cast("double")
    for r in found.groupBy(_G).agg(F.sum("n").alias("all")).collect():
        share = F.when(F.col(_G) == r[_G], F.lit(r["all"] / (spread * PARTS_OF_A_SHARE))).otherwise(share)
    found = found.withColumn(_APART, F.col(_G).isin(keyless) | (F.col("n") >= share))
    some = {tuple(r) for r in found.select(_G, _sampled_much(), _APART).distinct().collect()}
    if not some:
        return none
    spots = [f(u, found) for f, big in ((_sorted_edges, False), (_summed_edges, True)) if any(b is big for _, b, _ in some)]
    spots = spots[0].unionByName(spots[1]) if len(spots) > 1 else spots[0]
    spots = _kept(spots.withColumn(_P + "steps", F.slice(F.array(*[F.lit(1 << p) for p in reversed(range(_LEVELS))]), -_bits(F.size(_P + "edges")), _LEVELS)))
    split = {g for g, _, _ in some}
    tiers = [tuple(any(h == g and a is apart for h, _, a in some) for apart in (True, False)) for g in range(len(groups))]
    return [spots.filter(F.col(_G) == g).drop(_G) if g in split else None for g in range(len(groups))], tiers


_LEVELS = QUANTILES.bit_length() - 1


def _bits(n: Column) -> Column:
    """Binary digits of an int from 1 on."""
    return F.length(F.bin(n))


def _sampled_much() -> Column:
    return F.col("s") > SORTED_ROWS


def _sorted_edges(u: DataFrame, found: DataFrame) -> DataFrame:
    """Edges of keys with few sampled rows: the times at ``nb - 1`` even places of each key's own sorted sample.

    The work and the table grow with the rows and buckets of the keys, however many keys there are.
    """
    place = Window.partitionBy(_G, _H).orderBy(_TU)
    some = u.select(_G, _H, _TU).join(found.filter(~_sampled_much()).select(_G, _H, "s", "nb", _APART), [_G, _H])
    some = some.withColumn("i", F.row_number().over(place) - 1)
    # the first row of each of nb even parts but the first
    part = [F.floor(i * F.col("nb") / F.col("s")) for i in (F.col("i"), F.col("i") - 1)]
    some = some.filter((F.col("i") > 0) & (part[0] > part[1]))
    return some.groupBy(_G, _H).agg(F.array_sort(F.collect_set(_TU)).alias(_P + "edges"), F.first(_APART).alias(_APART))


def _summed_edges(u: DataFrame, found: DataFrame) -> DataFrame:
    """Edges of keys with many sampled rows, at most one in ``SORTED_ROWS``: from partial summaries, without a key in one task."""
    big = found.filter(_sampled_much()).select(_G, _H, "nb", _APART)
    spots = u.select(_G, _H, _TU).join(F.broadcast(big), [_G, _H]).groupBy(_G, _H).agg(
        F.first("nb").alias("nb"), F.first(_APART).alias(_APART), F.expr(f"percentile_approx({_TU}, array({_GRID}), 20000)").alias("q")
    )
    edges = F.array_distinct(
        F.transform(
            F.sequence(F.lit(1), F.col("nb") - 1),
            lambda j: F.element_at("q", F.greatest(F.lit(1), F.floor(j * QUANTILES / F.col("nb")).cast("int"))),
        )
    )
    return spots.select(_G, _H, edges.alias(_P + "edges"), _APART)


def _bucket_of(us: Column) -> Column:
    """The number of edges at or below ``us``, by halving: the steps are the powers of two up to the number of edges."""
    edges = F.col(_P + "edges")
    return F.aggregate(
        F.col(_P + "steps"), F.lit(0), lambda n, step: F.when(F.get(edges, n + step - 1) <= us, n + step).otherwise(n)
    ).cast("long")


def scan_stats(
    spark, entity: DataFrame, entity_ts: str, groups, hot_key_rows: int | None, bounds=None, prune: bool = True, shared=None
) -> ScanStats:
    """Entity time range, hot keys, key lists and sources of every scan.

    ``groups``: ``[(keys, sources), ...]``, one per scan (key set).

    1. A plain aggregate over the entity: rows, time range, the approximate
       number of distinct keys per key set and their measured size.  Given
       ``bounds`` are checked against the range: a bound that is too narrow would
       lose matches and raises.
    2. Derived sources are computed once, see the module's doc.
    3. A sampled count and time quantiles per key, for scans that can have a hot
       one.  They decide how finely a key is split, never what the join returns.
       Where no scan has one, the same count per ``shared`` keys over the rows
       of all scans tells whether these may go through one shuffle.
    """
    ets_type = entity.schema[entity_ts].dataType
    types = [_check(entity, entity_ts, keys, sources) for keys, sources in groups]
    us = epoch_micros(_c(entity_ts), ets_type)
    aggs = [F.count(F.lit(1)).alias("n"), F.min(us).alias("lo"), F.max(us).alias("hi")]
    for g, (keys, _) in enumerate(groups):
        if len(groups) > 1:
            aggs.append(F.approx_count_distinct(F.xxhash64(*[_c(k) for k in keys], _c(entity_ts)), 0.05).alias(f"d{g}"))
        if keys:
            aggs.append(F.approx_count_distinct(_key_hash(keys), 0.05).alias(f"k{g}"))
            aggs.append(F.avg(_key_bytes(types[g])).alias(f"b{g}"))
    row = entity.agg(*aggs).first()
    lo, hi = (None if row[c] is None else Micros(row[c]) for c in ("lo", "hi"))
    if bounds is not None and lo is not None and (lo < bounds[0] or hi > bounds[1]):
        raise ValueError(f"entity times reach from {lo} to {hi} (us), beyond the given bounds {bounds}")
    if bounds is None:
        bounds = ((lo, hi) if lo is not None else _NO_TIMES) if prune else (None, None)
    log.info("entity time range %s .. %s (us)", *bounds)
    limit = _broadcast_bytes(spark)
    few, ready, most = [], [], []
    for g, (keys, sources) in enumerate(groups):
        small = keys and row[f"k{g}"] * 1.2 * ((row[f"b{g}"] or 0) + 32) <= limit
        few.append(
            entity.select(*[_c(k).cast(types[g][k]).alias(k) for k in keys])
            .filter(" and ".join(f"{quoted(k)} is not null" for k in keys))
            .distinct()
            if small
            else None
        )
        known, out, own_keys = row["n"], [], []
        for s in sources:
            if _rereadable(s) or not shared_folder(spark):
                out.append(s)
                known = None
            else:
                s, n, k = _store_once(s, keys, types[g], ets_type, bounds, few[g])
                out.append(s)
                own_keys.append(k)
                known = None if known is None else known + n
        if keys and not small:
            few[g] = _bitmap_if_worth(spark, entity, keys, types[g], row[f"k{g}"], out, own_keys, ets_type, bounds, limit)
        ready.append(out)
        most.append(known)
    hot, tiers = _hot_keys(entity, entity_ts, [(keys, out) for (keys, _), out in zip(groups, ready)], types, hot_key_rows, bounds, most)
    log.info("as-of scans: %d with keys split by time", sum(h is not None for h in hot))
    one_shuffle = False
    if shared and all(h is None for h in hot):
        known = None if None in most else sum(most) - row["n"] * (len(groups) - 1)
        every = [(shared, [s for out in ready for s in out])]
        one_shuffle = _hot_keys(entity, entity_ts, every, types, hot_key_rows, bounds, [known])[0][0] is None
    distinct = [row[f"d{g}"] if len(groups) > 1 else row["n"] for g in range(len(groups))]
    return ScanStats(bounds, hot, few, ready, row["n"], distinct, one_shuffle, tiers)


def _key_bytes(types: dict) -> Column:
    """Bytes of a row's keys: text and binary as long as they are, others as a row stores them."""
    out = F.lit(0)
    for k, t in types.items():
        out = out + (F.coalesce(F.octet_length(_c(k)), F.lit(0)) if t.typeName() in ("string", "binary") else F.lit(16))
    return out


def _bitmap_if_worth(spark, entity, keys, types, n_keys: int, sources, own_keys: list, ets_type, bounds, limit: int) -> _Bitmap | None:
    """A bitmap of the entity's keys, where it stays below ``limit`` bytes and some source has over twice as many keys."""
    slots = 1 << max(_ROW_BITS, int(n_keys * _SLOTS_PER_KEY).bit_length())
    if slots // 8 > limit:
        return None
    if len(own_keys) < len(sources):  # sources that were not counted while they were written: their keys alone are read
        counts = []
        for s in sources:
            _, cond = _in_range(s, ets_type, bounds)
            counts.append(s.df.filter(cond).agg(F.approx_count_distinct(_source_hash(s, keys, types), 0.05)).first()[0])
        own_keys = counts
    return _key_bitmap(entity, keys, types, slots) if max(own_keys) > 2 * n_keys else None


def _broadcast_bytes(spark) -> int:
    """The session's broadcast threshold in bytes; 0 where broadcasts are off."""
    value = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return max(0, int(value))


def asof_join(
    entity: DataFrame,
    entity_ts: str,
    keys: Sequence[str],
    sources: Sequence[AsOfSource],
    *,
    prune: bool = True,
    bounds: tuple | None = None,
    hot_key_rows: int | None = DEFAULT_HOT_KEY_ROWS,
    stats: tuple | None = None,
) -> DataFrame:
    """As-of join of several sources that share the entity key set, in one scan.

    ``bounds`` (times, text or :class:`Micros`) are the entity time range where
    the caller knows it.  With ``hot_key_rows=None`` nothing is read ahead of the
    scan then and the bounds are trusted: too narrow ones lose matches.
    ``stats``: (bounds, hot table, key list, tiers) of a caller that has looked at the
    data already (:func:`scan_stats`; a fold does it once for all key sets).
    """
    entity_ts, keys, sources = _resolved(entity, entity_ts, keys, sources)
    types = _check(entity, entity_ts, keys, sources)
    spark = entity.sparkSession
    ets_type = entity.schema[entity_ts].dataType
    ent_cols = entity.columns
    # the entity time travels as the scan time; keys as the partition columns
    other_cols = [c for c in ent_cols if c not in keys and c != entity_ts]
    n = len(sources)
    fcols = [f"{_P}f{i}" for i in range(n)]

    if bounds is not None:
        bounds = tuple(to_micros(spark, b, ets_type) for b in bounds)
    if stats is not None:
        bounds, hot, few, tiers = stats
    elif hot_key_rows is not None or not keys:
        found = scan_stats(spark, entity, entity_ts, [(keys, sources)], hot_key_rows, bounds, prune)
        bounds, hot, few, tiers, sources = found.bounds, found.hot[0], found.few_keys[0], found.tiers[0], found.sources[0]
    else:
        hot, few, tiers = None, None, (False, False)
        if bounds is None:
            bounds = (None, None)
            if prune:
                bounds = entity_time_range(entity, entity_ts)
                bounds = bounds if bounds[1] is not None else _NO_TIMES

    src_rows = [
        _without_old_history(_source_rows(s, i, keys, types, ets_type, bounds, few), s, i, keys, ets_type, bounds)
        for i, s in enumerate(sources)
    ]
    ent_rows = entity.select(
        *[_c(k).cast(types[k]).alias(k) for k in keys],
        _c(entity_ts).alias(_T),
        F.lit(1).alias(_SIDE),
        F.struct(*[_c(c) for c in other_cols]).alias(_E),
    )
    u0 = ent_rows
    for s in src_rows:
        u0 = u0.unionByName(s, allowMissingColumns=True)

    orders = [_order_key(s, i, u0.schema) for i, s in enumerate(sources)]

    # the greatest created time of a TTL window: in this very scan where all rows of a key meet in one task
    apart, near = tiers
    windowed = [i for i, s in enumerate(sources) if s.created_rule == "independent_max" and s.created_ts and s.ttl_seconds > 0]
    fused = [] if apart else windowed
    if fused:
        u0 = _with_probes(u0, keys, sources, fused)
    u0 = _asked(_bucketed(u0, hot, keys, sources, fcols, orders, ets_type, tiers), sources, fused, ets_type)
    together = [_J, *keys] if near else [*keys, _B]
    part = [*together, _B] if near else together

    # Step 2: the scan.
    # A RANGE frame up to the current row includes its peers, so the frame of
    # an entity row holds every source row at or before its time (upper bound
    # inclusive) plus the carry row (NULL time, sorted first); the greatest
    # payload (event time, created, features) among them is the winner.  All
    # frames below share this one sort order: one sort, one Window operator.
    # (a stretch of time before the time itself changes no order, and is the sort of the window maximum)
    stretch = [F.col(f"{_P}w{i}").asc_nulls_first() for i in fused[:1] if not near]
    w = (
        Window.partitionBy(*[_c(c) for c in part])
        .orderBy(*stretch, F.col(_T).asc_nulls_first())
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    scanned_cols = [_c(c) for c in part] + [F.col(_T), F.col(_SIDE), F.col(_E)]
    extra = []
    for i, s in enumerate(sources):
        f = F.col(fcols[i])
        scanned_cols.append(_greatest_payload(f, orders[i]).over(w).alias(fcols[i]))
        if s.created_rule == "independent_max" and s.created_ts and s.ttl_seconds == 0:
            # greatest created time of all source rows at or before t: same running frame
            cvals = f[_F_C]
            if apart:
                cvals = F.greatest(cvals, F.col(f"{_P}cm{i}"))
            extra.append(F.max(cvals).over(w).alias(f"{_P}mc{i}"))
    scanned = u0.select(*scanned_cols, *extra, *_window_maxima(sources, fused, together))
    if near:
        scanned = _with_earlier_buckets(scanned, together, sources, orders)
    scanned = _maxima_at_entities(scanned, fused, together).filter(F.col(_SIDE) == 1)

    # Step 3: entity rows with their features.
    out_cols = []
    for c in ent_cols:
        if c in keys:
            out_cols.append(_c(c).cast(entity.schema[c].dataType).alias(c))
        elif c == entity_ts:
            out_cols.append(F.col(_T).alias(c))
        else:
            out_cols.append(F.col(_E)[c].alias(c))
    tie_cols = []
    pending = []  # independent_max with a TTL: gated after the join with the window maximum
    for i, s in enumerate(sources):
        f = F.col(fcols[i])
        ok = _in_time(s, f)
        if s.created_rule == "independent_max" and s.created_ts:
            if s.ttl_seconds == 0:
                ok = ok & (f[_F_C] == F.col(f"{_P}mc{i}"))
            else:
                if i in fused:
                    ok = ok & (f[_F_C] == F.col(f"{_P}m{i}"))
                else:
                    pending.append(i)
                    tie_cols.append(F.when(ok, f[_F_C]).alias(f"{_P}pc{i}"))
        if s.ties == "all":
            tie_cols += [
                F.when(ok, f[_F_TS]).alias(f"{_P}wts{i}"),
                F.when(ok, f[_F_C]).alias(f"{_P}wc{i}"),
            ]
        else:
            out_cols += [F.when(ok, f[n]).alias(n) for n in s.out_names()]
    result = scanned.select(*out_cols, *tie_cols)

    # independent_max with a TTL: keep the winner only if no candidate in
    # [t - ttl, t] was created later (window maximum from a streaming scan)
    for i in pending:
        s = sources[i]
        m = _range_created_max(entity, entity_ts, keys, types, s, i, ets_type, bounds, hot, few)
        result = result.join(m, on=keys + [entity_ts], how="left")
        gate = F.col(f"{_P}pc{i}") == F.col(f"{_P}m{i}")
        gated = [f"{_P}wts{i}", f"{_P}wc{i}"] if s.ties == "all" else s.out_names()
        result = result.withColumns({c: F.when(gate, _c(c)) for c in gated}).drop(f"{_P}pc{i}", f"{_P}m{i}")

    # Fan out to every tied source row.
    for i, s in enumerate(sources):
        if s.ties == "all":
            result = _fan_out_ties(result, s, i, keys, types, ets_type, bounds)

    final_cols = list(ent_cols) + [n for s in sources for n in s.out_names()]
    return result.select(*[_c(c) for c in final_cols])


def shared_keys(entity: DataFrame, entity_ts: str, groups) -> list | None:
    """The smallest key set where every other one contains it and :func:`nested_asof_join` can run them all, or None."""
    types = [_check(entity, entity_ts, keys, sources) for keys, sources in groups]
    keys = min((keys for keys, _ in groups), key=len, default=[])
    if len(groups) < 2 or not keys or any(not set(keys) <= set(ks) for ks, _ in groups):
        return None
    every = {k: t for ts in types for k, t in ts.items()}
    if any(every[k] != t for ts in types for k, t in ts.items()):
        return None  # keys are compared, and hashed, in other types from scan to scan
    plain = all(s.ties == "one" and not (s.created_ts and s.created_rule == "independent_max") for _, out in groups for s in out)
    return list(keys) if plain else None


def nested_asof_join(entity: DataFrame, entity_ts: str, shared, groups, bounds, few_keys) -> DataFrame:
    """As-of join of several key sets that all contain the ``shared`` keys, in one shuffle by these.

    Rows of all sources and the entity are dealt by the shared keys.  Rows that
    agree in more keys then lie together as well, so the scan of each key set is
    a sort and a window within the partitions, first the one by the shared keys,
    and the entity row is moved once, however many key sets there are.  For
    sources that :func:`shared_keys` lets pass and keys that need no split.
    """
    ets_type = entity.schema[entity_ts].dataType
    groups = sorted(zip(groups, few_keys), key=lambda g: len(g[0][0]))
    types = {}
    for (keys, sources), _ in groups:
        types.update(_check(entity, entity_ts, keys, sources))
    _check(entity, entity_ts, shared, [s for (_, sources), _ in groups for s in sources])  # names that collide
    other_cols = [c for c in entity.columns if c not in types and c != entity_ts]
    u = entity.select(
        *[_c(k).cast(t).alias(k) for k, t in types.items()],
        _c(entity_ts).alias(_T),
        F.lit(1).alias(_SIDE),
        F.struct(*[_c(c) for c in other_cols]).alias(_E),
    )
    scans = []
    for (keys, sources), few in groups:
        scan = []
        for s in sources:
            i = sum(len(done) for _, done in scans) + len(scan)
            rows = _without_old_history(_source_rows(s, i, keys, types, ets_type, bounds, few), s, i, keys, ets_type, bounds)
            u = u.unionByName(rows, allowMissingColumns=True)
            scan.append((i, s))
        scans.append((keys, scan))
    orders = {i: _order_key(s, i, u.schema) for _, scan in scans for i, s in scan}
    u = _bucketed(u, None, shared, [], [], [], ets_type)

    for keys, scan in scans:
        # of the rows of other scans none has a payload here; those of scans that are done are let go
        w = (
            Window.partitionBy(*[_c(c) for c in [*keys, _B]])
            .orderBy(F.col(_T).asc_nulls_first())
            .rangeBetween(Window.unboundedPreceding, Window.currentRow)
        )
        found = {f"{_P}f{i}": _greatest_payload(F.col(f"{_P}f{i}"), orders[i]).over(w) for i, _ in scan}
        u = u.select(*[found[c].alias(c) if c in found else _c(c) for c in u.columns])
        ahead = F.col(_SIDE) == 1
        for j in range(scan[-1][0] + 1, len(orders)):
            ahead = ahead | F.col(f"{_P}f{j}").isNotNull()
        u = u.filter(ahead)

    out_cols = []
    for c in entity.columns:
        if c in types:
            out_cols.append(_c(c).cast(entity.schema[c].dataType).alias(c))
        else:
            out_cols.append(F.col(_T).alias(c) if c == entity_ts else F.col(_E)[c].alias(c))
    for _, scan in scans:
        for i, s in scan:
            f = F.col(f"{_P}f{i}")
            out_cols += [F.when(_in_time(s, f), f[n]).alias(n) for n in s.out_names()]
    return u.select(*out_cols)


def _in_time(s: AsOfSource, f: Column) -> Column:
    """Whether an entity row's winner ``f`` is one, and not older than the TTL."""
    ok = f.isNotNull() & F.col(_T).isNotNull()
    return ok & (f[_F_TS] >= F.col(_T) - seconds_interval(s.ttl_seconds)) if s.ttl_seconds > 0 else ok


def _fan_out_ties(result: DataFrame, s: AsOfSource, i: int, keys, types, ets_type, bounds) -> DataFrame:
    """Equi-join back on (keys, winning event time[, created time])."""
    ts, cond0 = _in_range(s, ets_type, bounds)
    src = s.df.filter(cond0).select(
        *[_c(s.key_map[k]).cast(types[k]).alias(f"{_P}k_{k}") for k in keys],
        ts.alias(f"{_P}jts"),
        (_c(s.created_ts) if s.created_ts else F.lit(None).cast(ets_type)).alias(f"{_P}jc"),
        *[_c(f).alias(n) for f, n in zip(s.features, s.out_names())],
    )
    cond = F.col(f"{_P}wts{i}") == F.col(f"{_P}jts")
    for k in keys:
        cond = cond & (_c(k) == _c(f"{_P}k_{k}"))
    if s.created_ts:
        cond = cond & F.col(f"{_P}wc{i}").eqNullSafe(F.col(f"{_P}jc"))
    joined = result.join(src, cond, "left")
    drop = [f"{_P}k_{k}" for k in keys] + [f"{_P}jts", f"{_P}jc", f"{_P}wts{i}", f"{_P}wc{i}"]
    return joined.drop(*drop)


def _with_earlier_buckets(scanned: DataFrame, together, sources, orders) -> DataFrame:
    """Winners within the buckets -> winners: what is carried from the earlier buckets of a key whose buckets lie in one task."""
    before = Window.partitionBy(*[_c(c) for c in together]).orderBy(_B).rangeBetween(Window.unboundedPreceding, -1)
    carried, winners = {}, {}
    for i, s in enumerate(sources):
        f = f"{_P}f{i}"
        carried[f"{_P}y{i}"] = _greatest_payload(F.col(f), orders[i]).over(before)
        winners[f] = _greater_payload(F.col(f), F.col(f"{_P}y{i}"), lambda x, i=i, s=s: _order_key(s, i, scanned.schema, x))
        if f"{_P}mc{i}" in scanned.columns:
            carried[f"{_P}my{i}"] = F.max(f"{_P}mc{i}").over(before)
            winners[f"{_P}mc{i}"] = F.greatest(f"{_P}mc{i}", f"{_P}my{i}")
    return scanned.withColumns(carried).withColumns(winners).drop(*carried)


def _bucketed(u0: DataFrame, hot: DataFrame | None, keys, sources, fcols, orders, ets_type, tiers=(False, False)) -> DataFrame:
    """Add the bucket column, and carry rows for keys whose buckets are dealt apart.

    Other keys to split are small beside a task's share of the rows: theirs are
    dealt once, by ``_J``, to one task, find their edges there and take what is
    carried from there too (:func:`_with_earlier_buckets`).
    """
    # entity rows that cannot match need no scan: spread, below all buckets
    nowhere = (F.col(_SIDE) == 1) & F.col(_T).isNull()
    for k in keys:
        nowhere = nowhere | ((F.col(_SIDE) == 1) & _c(k).isNull())
    plain = [f.name for f in u0.schema[_E].dataType.fields if not _unhashable(f.dataType)]
    row = F.xxhash64(*[_c(k) for k in keys], F.col(_T), *[F.col(_E)[c] for c in plain])
    spread = -1 - F.pmod(row, F.lit(4096))
    if hot is None:
        return u0.withColumn(_B, F.when(nowhere, spread).otherwise(F.lit(0).cast("long")))
    apart, near = tiers
    u = u0
    if apart:
        u = _dealt_apart(u, hot.filter(_APART).drop(_APART), keys, sources, fcols, orders, nowhere, spread, ets_type)
    if not near:
        return u.drop(_APART)
    deal = _key_hash(keys)
    if apart:
        deal = F.when(F.col(_APART), F.xxhash64(deal, F.col(_B))).otherwise(deal)
    deal = F.when(nowhere, row).otherwise(deal)
    # what can be computed from a row is not shuffled with it
    u = u.repartition(deal).withColumn(_J, deal)
    u = u.join(hot.filter(~F.col(_APART)).drop(_APART).withColumnRenamed(_H, _J), on=_J, how="left")
    bucket = F.when(F.col(_P + "edges").isNotNull(), _bucket_of(epoch_micros(F.col(_T), ets_type))).otherwise(F.lit(0).cast("long"))
    if apart:
        bucket = F.when(F.col(_APART), F.col(_B)).otherwise(bucket)
    return u.withColumn(_B, F.when(nowhere, spread).otherwise(bucket)).drop(_APART, _P + "edges", _P + "steps")


def _dealt_apart(u: DataFrame, hot: DataFrame, keys, sources, fcols, orders, nowhere, spread, ets_type) -> DataFrame:
    """Rows with the buckets of the keys of ``hot`` (marked ``_APART``), and the carry rows of these."""
    is_hot = F.col(_P + "edges").isNotNull()
    time = u.schema[_T].dataType
    u = u.withColumn(_H, _key_hash(keys)).join(hot, on=_H, how="left").drop(_H).withColumn(_APART, is_hot)
    bucket = F.when(is_hot, _bucket_of(epoch_micros(F.col(_T), ets_type))).otherwise(F.lit(0).cast("long"))
    u = u.withColumn(_B, F.when(nowhere, spread).otherwise(bucket))

    # the greatest source row per (key, bucket) and view: partial top-1 before the shuffle.  Of the entity, which in a
    # fold is the previous scan, nothing is read: every later bucket of a key gets its carry row, asked for or not
    ks = [_c(k) for k in keys]
    last = F.size(_P + "edges").cast("long").alias(f"{_P}nb")  # the number of the key's last bucket
    summaries = []
    for i, s in enumerate(sources):
        own = u.filter((F.col(_SIDE) == 0) & is_hot & F.col(fcols[i]).isNotNull())
        order = orders[i] if orders[i] is not None else F.col(fcols[i])
        bw = Window.partitionBy(*ks, _B).orderBy(F.col(fcols[i])[_F_TS].desc_nulls_last(), order.desc_nulls_last())
        summaries.append(
            own.select(*ks, _B, last, fcols[i], order.alias(f"{_P}o"))
            .withColumn(f"{_P}rn", F.row_number().over(bw))
            .filter(F.col(f"{_P}rn") == 1)
            .select(*ks, _B, f"{_P}nb", fcols[i])
        )
        if s.created_rule == "independent_max" and s.ttl_seconds == 0 and s.created_ts:
            created = own.select(*ks, _B, last, F.col(fcols[i])[_F_C].alias("c"))
            summaries.append(created.groupBy(*ks, _B).agg(F.first(f"{_P}nb").alias(f"{_P}nb"), F.max("c").alias(f"{_P}bm{i}")))
    cu = summaries[0]
    for sm in summaries[1:]:
        cu = cu.unionByName(sm, allowMissingColumns=True)
    by_bucket = Window.partitionBy(*ks).orderBy(_B)
    cw = by_bucket.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    carried = [_greatest_payload(F.col(fcols[i]), orders[i]).over(cw).alias(fcols[i]) for i in range(len(sources))]
    cm_cols = []
    for i, s in enumerate(sources):
        if s.created_rule == "independent_max" and s.ttl_seconds == 0 and s.created_ts:
            cm_cols.append(F.max(F.col(f"{_P}bm{i}")).over(cw).alias(f"{_P}cm{i}"))
    upto = F.coalesce(F.lead(_B).over(by_bucket), F.col(f"{_P}nb")).alias(f"{_P}m")
    carry = cu.select(*ks, _B, upto, *carried, *cm_cols).filter(F.col(f"{_P}m") > F.col(_B))
    carry = carry.withColumn(_B, F.explode(F.sequence(F.col(_B) + 1, F.col(f"{_P}m"))))
    any_f = None
    for c in fcols:
        any_f = F.col(c).isNotNull() if any_f is None else any_f | F.col(c).isNotNull()
    carry = carry.filter(any_f).drop(f"{_P}m").withColumn(_SIDE, F.lit(0))
    # a carry row sorts first in its bucket (_t NULL, NULLs first)
    carry = carry.withColumn(_T, F.lit(None).cast(time)).withColumn(_APART, F.lit(True))

    u = u.drop(_P + "edges", _P + "steps")
    return u.unionByName(carry, allowMissingColumns=True)


def _unhashable(t: T.DataType) -> bool:
    if isinstance(t, T.ArrayType):
        return _unhashable(t.elementType)
    if isinstance(t, T.StructType):
        return any(_unhashable(f.dataType) for f in t.fields)
    return not isinstance(t, T.AtomicType) or isinstance(t, T.VariantType)
