"""Every constant that drives the engine's semantics, in one place."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields

# Names that tables and exports share.
BLOCK_TYPES = ("text", "title", "table", "image", "chart", "formula", "seal", "footnote", "header", "footer", "page_number", "unknown")
STATUSES = ("accepted", "repaired", "review", "unreadable", "failed")
SETTLED = ("accepted", "repaired")
TEMPLATE_TYPES = ("header", "footer", "page_number")
VISUAL_TYPES = ("table", "image", "chart", "formula")
ROUTING_FLAGS = (
    "SRC-002", "SRC-003", "LAY-002", "LAY-004", "TXT-001", "TXT-002", "TXT-003", "TXT-004", "TAB-001", "TAB-002", "TAB-003", "TAB-004",
    "TAB-005", "TAB-006", "TAB-007", "TAB-009", "TAB-010", "IMG-001", "IMG-002", "IMG-003", "FOR-001", "FOR-002", "FOR-003",
)
TASK_OF_TYPE = {"table": "table_to_cells", "image": "visual_analyze", "chart": "visual_analyze", "formula": "formula_to_latex", "seal": "seal_or_stamp"}
OTHER_TASK = "ocr_verify"
PARSER_TYPES = {
    "text": "text", "paragraph": "text", "aside_text": "text", "title": "title", "table": "table", "image": "image", "chart": "chart", "equation": "formula", "formula": "formula",
    "interline_equation": "formula", "seal": "seal", "footnote": "footnote", "page_footnote": "footnote", "header": "header", "footer": "footer", "page_number": "page_number",
}
VISUAL_NAMES = {"表格": "table", "图表": "chart", "流程图": "diagram", "照片": "photo", "印章": "seal"}
YES_WORDS = ("true", "1", "yes", "是", "同一张表")
FOOTNOTE_MARKS = {"①": "a", "②": "b", "③": "c", "④": "d", "⑤": "e"}
CHUNK_SCHEMA, LINEAR_SCHEMA = "multimodal-chunks-v3", "linear-document-units-v1"


@dataclass(frozen=True)
class Options:
    """Sizes count code points."""

    text_size: int = 1200
    text_overlap: int = 120
    table_row_group: int = 6
    page_work_unit: int = 64
    embedding_batch: int = 16
    template_share: float = 0.6
    margin_share: float = 0.35
    margin_top: float = 110.0
    margin_bottom: float = 890.0
    cover_ratio: float = 0.35
    repeated_char_share: float = 0.45
    blur_variance: float = 80.0
    low_contrast: float = 22.0
    dark_share: float = 0.25
    continuation_auto: float = 0.78
    continuation_ask: float = 0.48
    content_success: float = 0.60
    rrf_constant: int = 60
    result_limit: int = 8

    def __post_init__(self) -> None:
        if self.text_size <= 0 or not 0 <= self.text_overlap < self.text_size or self.table_row_group <= 0:
            raise ValueError("text_size and table_row_group must be positive, and the overlap less than text_size")

    @classmethod
    def from_environment(cls, values: Mapping[str, str] = os.environ) -> Options:
        """The defaults, with what variables like FOLIANT_TEXT_SIZE say instead."""
        given = {f.name: type(f.default)(values[f"FOLIANT_{f.name.upper()}"]) for f in fields(cls) if f"FOLIANT_{f.name.upper()}" in values}
        return cls(**given)


DEFAULT = Options()
