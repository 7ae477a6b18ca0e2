"""Job options."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Options:
    """Settings of one run; prefixes always end in a slash. Attachments have no size limit unless one is set."""

    input_prefix: str = "emails/"
    output_prefix: str = "emails-extracted/"
    max_attachment_bytes: int | None = None
    date_source: str = "header"
    meridiem: bool = False
    relax_markdown: bool = False
    strict_text_decoding: bool = False

    def __post_init__(self) -> None:
        for name in ("input_prefix", "output_prefix"):
            value = getattr(self, name)
            if not value.endswith("/"):
                object.__setattr__(self, name, value + "/")
        if self.date_source not in ("header", "key"):
            raise ValueError("date_source is 'header' or 'key'")
