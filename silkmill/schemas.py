"""Schemas of the entities that pipelines read and write, as DDL; readers take them so that nothing is inferred."""

from __future__ import annotations

FILE_LISTING = "filename string, dirs string, filepath string"
PAGE = "book_id string, page_number int, total_pages int, text string"
CHUNK = "page_content string, metadata struct<source string, file_path string, page_number int, total_pages int, title string, author string, subject string, keywords string>"
TITLED_PARAGRAPH = "content string, first_title string, second_title string"
BOOK_PARAGRAPH = f"content struct<{TITLED_PARAGRAPH.replace(' string', ': string')}, Q: array<string>, book_name: string>, title string"
QA_SET = "Q array<string>, content string, book_name string, first_title string, second_title string"
QA_ROW = "Q string, text string, book_name string, first_title string, second_title string"
QA_PAIR = "Q string, A string"
PARAMETER = "struct<type: string, description: string>"
FUNCTION = f"struct<name: string, description: string, parameters: struct<type: string, properties: map<string, {PARAMETER}>, required: array<string>>>"
TOOL_CALL_EXAMPLE = f"question string, function array<{FUNCTION}>, input_parameters array<struct<function_name: string, arguments: map<string, string>>>"
MODEL_OUTPUT = "raw string, parsed string, ok boolean"
RAW_DIALOGUE = "id string, urls string, Doctor_faculty string, Description string, Dialogue string"
DESCRIPTION = "disease string, detail string, past_treatment string, purpose string"
TRAINING_DIALOGUE = "instruction string, digs array<struct<speaker: string, text: string, choices: array<string>>>"
TOKEN_SEQUENCE = "input_ids array<int>, labels array<int>"
WORD_BOX = "page_id bigint, seq int, x0 double, y0 double, x1 double, y1 double, text string"
SPAN = "x0 double, y0 double, text string"
LAYOUT_BOX = "page_id bigint, seq int, type string, x1 int, y1 int, x2 int, y2 int"
OCR_LINE = "page_id bigint, seq int, text string, score double"
NODE = "labels array<string>, id bigint, name string, props map<string, string>"
EDGE = "id bigint, source bigint, target bigint, label string"
TREE_NODE = "id int, parent int, content string, label string"
VECTOR_DOCUMENT = "_id string, text string, vector array<float>, metadata struct<title: string, type: string>"
FEW_SHOT = "task string, label string, input string, output string"
CHAT_MESSAGE = "conv_id bigint, turn int, role string, text string"
SFT_ROW = "term string, input string, output string"
ALL = {k: v for k, v in list(globals().items()) if k.isupper()}
