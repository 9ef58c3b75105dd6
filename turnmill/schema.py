"""Column types shared by the operators."""

from __future__ import annotations

MESSAGES = "array<struct<role:string,content:string>>"

QUALITY = (
    "struct<clarity:int,completeness:int,naturalness:int,correctness:int,"
    "domain_fit:int,overall:int,reason:string,parse_failed:boolean,raw:string,error:string>"
)

# Length bounds (characters) and their token approximation.
CHARS_PER_TOKEN = 4
MIN_CHARS = 10 * CHARS_PER_TOKEN
MAX_CHARS = 8192 * CHARS_PER_TOKEN
