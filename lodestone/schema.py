"""Schemas of blocks, chunks, embeddings and points, and conventions they share."""

from __future__ import annotations

FILE = "path string, file_name string, file_size long, created_at timestamp, modified_at timestamp, doc_type string, content binary, error string"
BLOCK = "struct<type:string,content:string,level:int,is_table:boolean,is_code:boolean,page_number:int,slide_number:int,sheet_name:string,metadata:map<string,string>>"
CHUNK = (
    "id string, doc_id string, chunk_index int, full_text string, summary_text string, title_text string, heading_path array<string>, section_title string, "
    "is_table boolean, is_code boolean, doc_type string, source_path string, page_number int, slide_number int, sheet_name string, metadata map<string,string>"
)
EMBEDDING = "chunk_id string, full_vector array<float>, summary_vector array<float>"
EMPTY_TEXT, EMPTY_SUMMARY = "[Empty document]", "Empty document"


def names(ddl: str) -> list[str]:
    """The column names of a flat DDL string, columns parted by a comma and a blank."""
    return [c.split(" ", 1)[0] for c in ddl.split(", ")]
