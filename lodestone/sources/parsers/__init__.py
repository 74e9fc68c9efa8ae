"""Format decoders: bytes of a file to ordered blocks and document metadata.

A new format is a function (bytes) -> (blocks, metadata) under its document type in
PARSERS, and its extensions in functions.text.DOC_TYPES.
"""

from __future__ import annotations

from collections.abc import Callable

from lodestone.sources.parsers import html, mail, md, office, pdf, txt
from lodestone.sources.parsers.common import Block

Parser = Callable[[bytes], tuple[list[Block], dict]]

PARSERS: dict[str, Parser] = {
    "txt": txt.parse, "md": md.parse, "html": html.parse, "pdf": pdf.parse, "docx": office.parse_docx, "xlsx": office.parse_xlsx,
    "pptx": office.parse_pptx, "ppt": office.parse_ppt, "eml": mail.parse_eml, "msg": mail.parse_msg,
}


def parse(data: bytes, doc_type: str) -> tuple[list[Block], dict]:
    """Blocks and metadata of a file of a type; ValueError for one that is not supported."""
    if doc_type not in PARSERS:
        raise ValueError(f"Unsupported document type: {doc_type}")
    return PARSERS[doc_type](data)
