"""Fixed values of the document engine, as one frozen configuration."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    """Sizes in characters, distances in points."""

    max_tokens: int = 512
    overlap_tokens: int = 50
    chars_per_token: int = 4
    chars_per_page: int = 3000
    caption_tokens: int = 80
    row_snap: float = 4.0
    column_snap: float = 6.0
    column_merge_gap: float = 50.0
    page_top: float = 150.0
    column_presence: float = 0.5
    column_consistency: float = 0.7
    min_rows: int = 2
    max_rows: int = 30
    max_cell: int = 60
    long_cell_ratio: float = 0.2
    short_cell_ratio: float = 0.5
    sparse_column: float = 0.4
    raster_min: int = 60
    caption_gap: float = 35.0
    caption_chars: int = 250
    cluster_gap: float = 60.0
    figure_height: float = 30.0
    figure_width: float = 40.0
    line_snap: float = 3.0
    caption_next: float = 30.0
    caption_slack: float = 25.0
    next_page_band: float = 0.3
    table_overlap: float = 0.5
    better_margin: float = 0.1
    header_likeness: float = 0.6
    zone_overlap: float = 2.0

    @property
    def max_chars(self) -> int:
        return self.max_tokens * self.chars_per_token

    @property
    def overlap_chars(self) -> int:
        return self.overlap_tokens * self.chars_per_token


DEFAULT = Config()
