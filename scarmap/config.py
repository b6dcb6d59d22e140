"""Fixed values of the domain and the settings of a run."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta

# Areas of interest, bands, dates, reducer names.
AREAS = [f"UKR{n}" for n in range(1, 19)]
AREAS_TRAIN = AREAS[:4]
AREAS_TEST = AREAS[4:]
BANDS_S1 = ["VV", "VH"]
BANDS_S2 = ["B1", "B2", "B3", "B4", "B5", "B6", "B7", "B8", "B8A", "B9", "B11", "B12"]
EVENT_DATE = date(2022, 2, 24)
REDUCERS = ["mean", "stdDev", "median", "min", "max", "skew", "kurtosis"]
DAMAGE_CLASSES = [1, 2]
# (area, relative orbit) pairs that are listed but must not be read.
BAD_ORBITS = {"UKR8": [109]}
CLOUD_BAND, CLEAR_THRESHOLD = "cs", 0.6
MIN_IMAGES_PER_ORBIT = 5
DAMAGE_THRESHOLD, MIN_AREA = 0.655, 50
LEVELS = 255
TILE_ZOOM = 8
NEAR_METRES = 5.0


@dataclass(frozen=True)
class Period:
    """Half-open time range: ``start`` belongs to it, ``end`` does not."""

    start: date
    end: date

    @staticmethod
    def of(start: str, end: str) -> "Period":
        return Period(date.fromisoformat(start), date.fromisoformat(end))

    def __str__(self) -> str:
        return f"{self.start}_{self.end}"


def windows(first: date, months: int, count: int) -> list[Period]:
    """``count`` windows of ``months`` months; each ends the day before the next one starts."""

    def start(i: int) -> date:
        month = first.month - 1 + i * months
        return date(first.year + month // 12, month % 12 + 1, first.day)

    return [Period(start(i), start(i + 1) - timedelta(days=1)) for i in range(count)]


OBSERVED = Period.of("2020-02-24", "2024-02-24")
PRE = [Period.of("2020-02-24", "2021-02-23")]
POST_QUARTERS = windows(date(2021, 2, 24), 3, 8)
POST_YEARS = windows(date(2021, 2, 24), 12, 2)
# Window starts used by the country statistics: before and after the event date.
NEGATIVE_STARTS = [p.start for p in POST_QUARTERS[:4]]
POSITIVE_STARTS = [p.start for p in windows(date(2022, 2, 24), 3, 8)]
# 170 thresholds from 0.1 in steps of 0.005
THRESHOLDS = [0.1 + i * 0.005 for i in range(170)]


@dataclass(frozen=True)
class RunConfig:
    """Settings of one experiment or one country run."""

    run_id: str = "run"
    model_name: str = "random_forest"
    model_kwargs: dict = field(default_factory=lambda: {"trees": 50, "min_leaf": 3})
    # None: sensor not used. An empty list: all its bands.
    s1_bands: list[str] | None = field(default_factory=list)
    s2_bands: list[str] | None = None
    aois_train: list[str] = field(default_factory=lambda: list(AREAS_TRAIN))
    aois_test: list[str] = field(default_factory=lambda: list(AREAS_TEST))
    damages: list[int] | None = field(default_factory=lambda: list(DAMAGE_CLASSES))
    window: list[str] = field(default_factory=lambda: ["1x1"])
    pre: list[Period] = field(default_factory=lambda: list(PRE))
    post: list[Period] = field(default_factory=lambda: list(POST_QUARTERS))
    reducers: list[str] = field(default_factory=lambda: list(REDUCERS))
    event_date: date = EVENT_DATE
    seed: int = 0
    aggregation: str = "mean"
    train_on_all: bool = False
    tile_zoom: int = TILE_ZOOM

    @property
    def sensors(self) -> str:
        """Which feature table the run reads: ``s1``, ``s2`` or ``s1_s2``."""
        used = [n for n, b in (("s1", self.s1_bands), ("s2", self.s2_bands)) if b is not None]
        if not used:
            raise ValueError("no sensor selected")
        return "_".join(used)

    @property
    def bands(self) -> list[str]:
        s1 = [] if self.s1_bands is None else (self.s1_bands or BANDS_S1)
        s2 = [] if self.s2_bands is None else (self.s2_bands or BANDS_S2)
        return [*s1, *s2]

    @property
    def features(self) -> list[str]:
        """Model input columns: band x period x window x reducer."""
        return feature_names(self.bands, self.window, self.reducers)

    @property
    def period_name(self) -> str:
        return period_name(self.post)


def feature_names(bands, window, reducers, periods=("pre", "post")) -> list[str]:
    window = [window] if isinstance(window, str) else window
    return [f"{b}_{p}_{w}_{r}" for b in bands for p in periods for w in window for r in reducers]


def period_name(post: list[Period]) -> str:
    return "1year" if len(post) == 2 else "3months"
