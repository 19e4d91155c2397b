from keyfold.functions.globs import glob_prefix, glob_to_regex
from keyfold.functions.values import (
    INEXACT_NUMBER,
    entries_of,
    entry,
    entry_text,
    int_of,
    is_null,
    is_object,
    joined_object,
    json_token,
    let,
    long_of,
    object_json,
    quoted,
    render_object,
    text_of,
)

__all__ = [
    "INEXACT_NUMBER",
    "entries_of",
    "entry",
    "entry_text",
    "glob_prefix",
    "glob_to_regex",
    "int_of",
    "is_null",
    "is_object",
    "joined_object",
    "json_token",
    "let",
    "long_of",
    "object_json",
    "quoted",
    "render_object",
    "text_of",
]
