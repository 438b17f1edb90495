"""Feature groups and study presets passed to every operator."""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class FeatureSpec:
    """Column groups of the model/cluster input (names, never positions)."""

    num: tuple[str, ...] = ("log_price", "age", "desc_len_chars", "desc_words")
    bin: tuple[str, ...] = ("price_missing", "age_missing", "has_designation", "has_region")
    cat: tuple[str, ...] = ("country", "province", "variety", "taster_name")
    text: str | None = "description"
    target: str = "high_quality"
    id_col: str = "row_id"

    def without(self, *cols: str) -> "FeatureSpec":
        """Same spec minus some columns (ablation, M11)."""
        drop = set(cols)
        return replace(self, num=tuple(c for c in self.num if c not in drop),
                       bin=tuple(c for c in self.bin if c not in drop),
                       cat=tuple(c for c in self.cat if c not in drop),
                       text=None if self.text in drop else self.text)

    @property
    def tabular(self) -> tuple[str, ...]:
        return self.num + self.bin + self.cat


# Fixed values of the studied catalogue (must equal the reference's for
# identical results): score threshold 90, reference vintage year 2017,
# price cap quantile 0.999, rare-level pooling below 200 training rows,
# seed 42, vintage token 1950-2019, price band edges 0/15/30/60/120/100000
# with labels <15, 15-30, 30-60, 60-120, >120, fill value "Unknown",
# dropped columns taster_twitter_handle and region_2.
@dataclass(frozen=True)
class Preset:
    threshold: int = 90
    ref_year: int = 2017
    cap_q: float = 0.999
    min_freq: int = 200
    seed: int = 42
    year_regex: str = r"\b(19[5-9]\d|20[01]\d)\b"
    band_edges: tuple[float, ...] = (0.0, 15.0, 30.0, 60.0, 120.0, 1e5)
    band_labels: tuple[str, ...] = ("<15", "15-30", "30-60", "60-120", ">120")
    fill_value: str = "Unknown"
    fill_cols: tuple[str, ...] = ("country", "province", "taster_name")
    strip_cols: tuple[str, ...] = ("country", "province", "variety", "taster_name",
                                   "designation", "region_1", "winery")
    drop_cols: tuple[str, ...] = ("taster_twitter_handle", "region_2")
    dedup_keys: tuple[str, ...] = ("description", "title")
    unicode_ws: bool = True
    spec: FeatureSpec = field(default_factory=FeatureSpec)

    def with_(self, **kw) -> "Preset":
        return replace(self, **kw)


WINE = Preset()
# The driver-table "orders_review" view carries years 1995-2001; 2000 makes
# the last year fall outside the range, like 2018 in the catalogue.
# Order totals run to ~500 000, so its price bands are scaled up.
ORDERS = Preset(ref_year=2000, unicode_ws=False,
                band_edges=(0.0, 60000.0, 120000.0, 240000.0, 360000.0, 1e7),
                band_labels=("<60k", "60k-120k", "120k-240k", "240k-360k", ">360k"))
