"""Families of columns chosen by the grammar of their names."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import product

from . import names

# The patterns of the column-name grammar.
_CHANNEL = r"[a-zA-Z0-9-]+(?:_\d+)?"
_AXES = r"(\W[abc])?(\W[xyz])?"
_LABEL = [rf"^{f}((.lower)|(.upper)|(Direction)|(Vertices)|(Size)|(Origin))?{_AXES}$" for f in names.LABEL_FEATURES]
_INTENSITY = [rf"^({_CHANNEL}_)?{f}{_AXES}$" for f in names.INTENSITY_FEATURES]
_COLOC = [rf"^({_CHANNEL}\W{_CHANNEL}_)?{f}$" for f in names.COLOC_FEATURES]
_DISTANCE = [rf"^([a-zA-Z0-9_]+_)?{f}{t}(\W[xyz])?$" for f, t in product(names.DISTANCE_FEATURES, names.DISTANCE_FUNCTIONS)]
_NUMBER = r"\d+(\.\d+)?"
_GRAPH = rf"(DELAUNAY|TOUCH)s?(:th={_NUMBER})?:\d+s?_"
_NEAR = rf"(RAD|KNN)d?s?:{_NUMBER}s?_"
_DENSITY = [rf"^{_GRAPH}Count$", rf"^RADd?s?:{_NUMBER}s?_Count$", rf"^KNNd:{_NUMBER}s?_"]
_NEIGHBORHOOD = [rf"^{_GRAPH}.*$", rf"^{_NEAR}.*$"]
_HIERARCHY = [r"^parent\W.+$"]
_INDEX = [f"^{c}$" for c in ("well", "ROI", "index", "object", "label", "channel", "stain", "acquisition", "path_in_well", "channel_pair")]


@dataclass(frozen=True)
class Selector:
    """A test on a column's name; ``|``, ``&``, ``-`` and ``~`` combine selectors."""

    test: Callable[[str], bool]

    def __or__(self, other: Selector) -> Selector:
        return Selector(lambda c: self.test(c) or other.test(c))

    def __and__(self, other: Selector) -> Selector:
        return Selector(lambda c: self.test(c) and other.test(c))

    def __sub__(self, other: Selector) -> Selector:
        return Selector(lambda c: self.test(c) and not other.test(c))

    def __invert__(self) -> Selector:
        return Selector(lambda c: not self.test(c))

    def expand(self, df_or_columns) -> list[str]:
        """The matching columns, in the frame's order."""
        columns = getattr(df_or_columns, "columns", df_or_columns)
        return [c for c in columns if self.test(c)]


def matches(*patterns: str) -> Selector:
    compiled = [re.compile(p) for p in patterns]
    return Selector(lambda c: any(p.search(c) for p in compiled))


label = matches(*_LABEL)
intensity = matches(*_INTENSITY)
correlation = matches(*_COLOC)
distance = matches(*_DISTANCE)
density = matches(*_DENSITY)
neighborhood = matches(*_NEIGHBORHOOD)
features = label | intensity | correlation | distance | density | neighborhood
hierarchy = matches(*_HIERARCHY)
index = matches(*_INDEX) | hierarchy
site_index = matches("^ROI$", "^object$", "^label$") | hierarchy
obj_index = site_index - hierarchy
meta = ~features
empty = Selector(lambda c: False)


def is_selector(x) -> bool:
    return isinstance(x, Selector)


def expand_all(df) -> dict[str, tuple[str, ...]]:
    """Every family's columns of ``df``."""
    families = {"empty": empty, "index": index, "site_index": site_index, "obj_index": obj_index, "meta": meta, "hierarchy": hierarchy, "label": label, "intensity": intensity, "correlation": correlation, "distance": distance, "density": density, "neighborhood": neighborhood, "features": features}
    return {k: tuple(v.expand(df)) for k, v in families.items()}


def chosen(df, columns: Selector | Sequence[str]) -> list[str]:
    return columns.expand(df) if is_selector(columns) else list(columns)


def channels(all_: Sequence[str], include: Sequence[str] | None = None, exclude: Sequence[str] | None = None) -> list[str]:
    """The channels to measure; an unknown name in either list is an error."""
    for c in [*(include or ()), *(exclude or ())]:
        if c not in all_:
            raise ValueError(f"no channel {c!r} among {list(all_)}")
    return [c for c in all_ if (not include or c in include) and c not in (exclude or ())]
