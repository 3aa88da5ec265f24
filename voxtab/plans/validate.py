"""Checked inputs of the flows."""

from __future__ import annotations

from dataclasses import dataclass, field

CORRECTIONS = tuple(f"correctionFactor-{m}" for m in ("Exp", "ExpNoOffset", "Linear", "LogLinear"))


@dataclass(frozen=True)
class Channel:
    """A channel by exactly one of its wavelength id or its label."""

    wavelength_id: str | None = None
    label: str | None = None

    def __post_init__(self):
        if self.wavelength_id and self.label:
            raise ValueError("wavelength_id and label cannot both be set")
        if self.wavelength_id is None and self.label is None:
            raise ValueError("one of wavelength_id and label must be set")


@dataclass(frozen=True)
class ChannelPair:
    channel0: Channel
    channel1: Channel


@dataclass(frozen=True)
class IntensityInput:
    measure: bool = False
    channels_to_include: tuple[str, ...] | None = None
    channels_to_exclude: tuple[str, ...] | None = None


@dataclass(frozen=True)
class DistanceInput:
    label_name_to: str | None = None


@dataclass(frozen=True)
class ColocalizationInput:
    channel_pair: tuple[ChannelPair, ...] = field(default=())


@dataclass(frozen=True)
class NeighborhoodInput:
    measure: bool = False
    label_img_mask: str | None = None

    def __post_init__(self):
        if not self.measure and self.label_img_mask is not None:
            raise ValueError("a mask is given although neighbourhoods are not measured")


@dataclass(frozen=True)
class AcquisitionFolder:
    acquisition: int
    image_dir: str


@dataclass(frozen=True)
class TimeDecayInput:
    correction_factor: str | None = None
    table_name: str | None = None

    def __post_init__(self):
        if self.correction_factor is None and self.table_name:
            raise ValueError("a table is given without the correction factor to use")
        if self.correction_factor is not None and self.correction_factor not in CORRECTIONS:
            raise ValueError(f"unknown correction factor {self.correction_factor!r}")


@dataclass(frozen=True)
class RegistrationInit:
    reference_url: str


def check_labels(most: int | None, limit: int = 65_535) -> None:
    """An error where labels do not fit 16 bits."""
    if most is not None and most > limit:
        raise ValueError(f"label {most} is above {limit}")


def check_masking(rois, masked: bool) -> None:
    """With masks, each ROI is named after its masking object's label."""
    if masked and (bad := [r for r in rois if not str(r).lstrip("-").isdigit()]):
        raise ValueError(f"ROIs are not named after masking labels: {bad[:3]}")
