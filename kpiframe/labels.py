"""Label pack: every text label and category value the builders use.

Builders take a :class:`Labels` so nothing is hard-coded inside a plan. The
defaults fit the mapped driver tables (see ``kpiframe.sources.mapped``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values. These texts must equal the original report's wording for the
# rendered output to match, so they are stated here plainly and in one place.
# ---------------------------------------------------------------------------
UP_PREFIX = "meningkat sebanyak "
DOWN_PREFIX = "menurun sebanyak "
FLAT_TEXT = "Tetap 0%"
TRAFFIC_FLAT_TEXT = "tidak berubah"
TRAFFIC_NA_TEXT = "N/A"
LIST_SEPARATOR = ", "
LIST_LAST_SEPARATOR = " dan "
SUMMARY_SUFFIX = " mengalami peningkatan dari bulan lalu."
SUMMARY_NONE = "Tidak ada metrik utama yang mengalami peningkatan dari bulan lalu."
# Traffic metric names in summary order (visitors, page views, engagement
# rate, engagement time, bounce rate).
METRIC_NAMES = ("total visitor", "page view", "engagement rate", "engagement time", "bounce rate")
# Month label pattern ("November 2025") and ISO date text.
MONTH_LABEL_PATTERN = "MMMM yyyy"
ISO_DATE_PATTERN = "yyyy-MM-dd"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Labels:
    """Category values and label -> slot-suffix maps for one report family."""

    # K1, K2: products kept, each with its slot suffix.
    products: tuple[str, ...] = ("BUILDING", "MACHINERY", "HOUSEHOLD")
    product_suffix: dict[str, str] = field(
        default_factory=lambda: {"BUILDING": "building", "MACHINERY": "machinery", "HOUSEHOLD": "household"}
    )
    # K4: products whose open orders are shared out.
    share_products: tuple[str, ...] = ("BUILDING", "MACHINERY")
    # K3, K4: order statuses.
    excluded_statuses: tuple[str, ...] = ("1-URGENT", "2-HIGH")
    closed_status: str = "5-LOW"
    document_status: str = "4-NOT SPECIFIED"
    # K5: customer type kept and the two device arms (name -> counter columns).
    customer_type: str = "O"
    device_arms: tuple[tuple[str, tuple[str, ...]], ...] = (
        ("bundle", ("cumulative_a", "cumulative_b", "cumulative_c")),
        ("single", ("cumulative_d",)),
    )
    # K6-K9: traffic event types and properties with their slot suffixes.
    page_view_event: str = "view"
    key_events: tuple[str, ...] = ("purchase", "signup")
    property_suffix: dict[str, str] = field(
        default_factory=lambda: {"website": "website", "mobile": "mobile", "partner": "partner"}
    )

    @property
    def open_excluded(self) -> tuple[str, ...]:
        """Statuses that are not open: the excluded ones plus the closed one."""
        return tuple(self.excluded_statuses) + (self.closed_status,)

    def __post_init__(self) -> None:
        for suffixes in (self.product_suffix, self.property_suffix):
            if len(set(suffixes.values())) < len(suffixes):
                raise ValueError(f"two labels share a slot suffix: {suffixes}")

    def __hash__(self) -> int:  # dict fields are not hashable by default
        return hash((self.products, self.share_products, self.excluded_statuses, self.closed_status,
                     self.document_status, self.customer_type, self.device_arms))


DEFAULT_LABELS = Labels()
