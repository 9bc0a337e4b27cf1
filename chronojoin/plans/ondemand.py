"""On-demand views: features computed from other features and request columns (§2.7)."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.entity import column_named, quoted


@dataclass(frozen=True)
class OnDemandView:
    """Named outputs computed from declared ``inputs``.

    An input is ``"view:feature"``, of a feature view or of another on-demand
    view, or the name of a request column, one of the entity table's.  An
    output is a function that gets the inputs as ``{input: Column}`` and returns
    a Column, so it becomes part of the plan.  An input that no function asks
    for is still joined; one that is not declared is not there.
    """

    name: str
    inputs: Sequence[str]
    outputs: Mapping[str, Callable[[Mapping[str, Column]], Column]]

    def __post_init__(self) -> None:
        if not self.outputs:
            raise ValueError(f"on-demand view {self.name!r} has no outputs")


def resolve_on_demand(views, on_demand: Sequence[OnDemandView], refs: Sequence[str], entity: DataFrame):
    """(references to join, on-demand views in the order of their dependencies) for ``refs``.

    Raises on names that occur twice, unknown references or request columns, and
    views that need each other, before anything runs.
    """
    by_name = {v.name: v for v in on_demand}
    names = [*(v.name for v in views), *(v.name for v in on_demand)]
    twice = sorted({n for n in names if names.count(n) > 1}) if on_demand else []
    if twice:
        raise ValueError("views of the same name: " + ", ".join(twice))
    joined: dict[str, None] = {}
    done: dict[str, OnDemandView] = {}

    def visit(ref: str, path: tuple[str, ...]) -> None:
        view, _, feature = ref.partition(":")
        if view not in by_name:
            joined[ref] = None  # checked with the feature views
            return
        if feature not in by_name[view].outputs:
            raise ValueError(f"unknown output {feature!r} of on-demand view {view!r}")
        if view in path:
            raise ValueError("on-demand views need each other: " + " -> ".join([*path[path.index(view) :], view]))
        if view in done:
            return
        for one in by_name[view].inputs:
            if ":" in one:
                visit(one, (*path, view))
            elif column_named(entity, one) is None:
                raise ValueError(f"on-demand view {view!r} needs the request column {one!r}; the entity table lacks it")
        done[view] = by_name[view]

    for ref in refs:
        if ":" not in ref:
            raise ValueError(f"feature reference {ref!r} is not 'view:feature'")
        visit(ref, ())
    return list(joined), list(done.values())


def computed(df: DataFrame, plan: Sequence[OnDemandView], out_name) -> DataFrame:
    """``df`` with the outputs of ``plan``; ``out_name(view, feature)`` names features and outputs."""
    for view in plan:
        inputs = {
            i: F.col(quoted(out_name(*i.split(":", 1)) if ":" in i else column_named(df, i))) for i in view.inputs
        }
        made = {out_name(view.name, n): f(dict(inputs)) for n, f in view.outputs.items()}
        wrong = [n for n, c in made.items() if not isinstance(c, Column)]
        if wrong:
            raise TypeError(f"on-demand view {view.name!r} returned no Column for " + ", ".join(wrong))
        df = df.withColumns(made)
    return df
