"""Names of features and columns.

Column names carry meaning: ``<channel>_<Feature>``, ``<a>|<b>_<Metric>``, ``<query>_<Agg>``.
They hold dots, dashes, bars and colons, so expressions quote them with :func:`q`.
"""

from __future__ import annotations

# Feature names that users of feature tables rely on.
LABEL_FEATURES = (
    "PhysicalSize", "NumberOfPixels", "Elongation", "Flatness", "Roundness", "FeretDiameter", "Perimeter",
    "EquivalentSphericalPerimeter", "EquivalentSphericalRadius", "NumberOfPixelsOnBorder", "PerimeterOnBorder",
    "PerimeterOnBorderRatio", "Centroid", "PrincipalAxes", "PrincipalMoments", "EquivalentEllipsoidDiameter",
    "BoundingBox", "OrientedBoundingBox",
)
DEFAULT_LABEL_FEATURES = (
    "PhysicalSize", "Elongation", "Flatness", "Roundness", "Perimeter", "EquivalentSphericalPerimeter",
    "EquivalentSphericalRadius", "PerimeterOnBorderRatio", "Centroid", "PrincipalAxes",
    "EquivalentEllipsoidDiameter", "BoundingBox", "OrientedBoundingBox",
)
POSITION_FEATURES = ("Centroid", "PrincipalAxes", "EquivalentEllipsoidDiameter", "BoundingBox", "OrientedBoundingBox")
INTENSITY_FEATURES = (
    "Mean", "Median", "Minimum", "Maximum", "Sum", "Variance", "StandardDeviation", "Skewness", "Kurtosis",
    "WeightedElongation", "WeightedFlatness", "CenterOfGravity", "WeightedPrincipalAxes",
    "WeightedPrincipalMoments", "MaximumIndex", "MinimumIndex",
)
COLOC_FEATURES = ("PearsonR", "SpearmanR", "KendallTau", "Chi2Contingency", "MutualInfo", "MutualInfoBins", "MutualInfoNormalized")
DEFAULT_COLOC_FEATURES = ("PearsonR", "SpearmanR", "KendallTau")
DISTANCE_FEATURES = ("Centroid", "Maximum", "Minimum", "Median", "MaximumIndex", "MinimumIndex")
DEFAULT_DISTANCE_FEATURES = ("Centroid", "Maximum", "Minimum")
DISTANCE_FUNCTIONS = ("DistanceToBorder", "DistanceAlongZ", "DistanceAlongY", "DistanceAlongX")
DEFAULT_DISTANCE_FUNCTIONS = ("DistanceToBorder", "DistanceAlongZ")
PRESET_RADII = (10, 20, 30, 40, 50, 80, 100, 150, 200, 250)
PRESET_K = (2, 5, 10, 20, 50, 100, 200)


def q(name: str) -> str:
    """``name`` quoted for ``F.col``."""
    return f"`{name.replace('`', '``')}`"


def pascal(member: str) -> str:
    """``PEARSON_R`` as ``PearsonR``."""
    return "".join(part.capitalize() for part in member.split("_"))


def requested(props, available) -> tuple[str, ...]:
    """The names in ``available`` that begin with one of ``props``, in their own order.

    Asking for ``Perimeter`` also gives ``PerimeterOnBorder`` and its ratio.
    """
    return tuple(a for a in available if any(a.startswith(p) for p in props))


def intensity(channel: str, feature: str) -> str:
    return f"{channel}_{feature}"


def coloc(a: str, b: str, metric: str) -> str:
    return f"{a}|{b}_{metric}"


def distance(label_to: str, feature: str, function: str) -> str:
    return f"{label_to}_{feature}{function}"
