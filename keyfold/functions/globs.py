"""Key patterns: ``*``, ``?``, ``[abc]``, ``[a-z]``, ``[^a]`` and backslash escapes."""

from __future__ import annotations

import re

_META = set("*?[\\")


def glob_prefix(pattern: str) -> str:
    """The literal text every matching key starts with; lets a scan skip row groups."""
    for at, char in enumerate(pattern):
        if char in _META:
            return pattern[:at]
    return pattern


def _escape(char: str) -> str:
    return char if char.isalnum() or ord(char) > 127 else "\\" + char


_TOKEN = re.compile(
    r"""(?P<many>\*+)
      | (?P<one>\?)
      | \[(?P<negated>\^?)(?P<members>(?:\\.|[^\]\\])*)(?:\]|\\?$)
      | \\(?P<escaped>.)
      | (?P<plain>.)""",
    re.S | re.X,
)
_MEMBER = re.compile(r"(?:\\(?P<escaped>.)|(?P<low>.)-(?P<high>.)|(?P<plain>.))", re.S)


def _char_class(members: str, negated: bool) -> str:
    if not members:
        return "." if negated else "(?!)"
    parts = []
    for member in _MEMBER.finditer(members):
        if member["low"]:
            low, high = sorted((member["low"], member["high"]))
            parts.append(f"{_escape(low)}-{_escape(high)}")
        else:
            parts.append(_escape(member["escaped"] or member["plain"]))
    return f"[{'^' if negated else ''}{''.join(parts)}]"


def glob_to_regex(pattern: str) -> str:
    """Anchored regular expression, in the syntax Java and RE2 share, for a key pattern."""
    parts = []
    for token in _TOKEN.finditer(pattern):
        if token["many"]:
            parts.append(".*")
        elif token["one"]:
            parts.append(".")
        elif token["members"] is not None:
            parts.append(_char_class(token["members"], bool(token["negated"])))
        else:
            parts.append(_escape(token["escaped"] or token["plain"]))
    return f"^(?s:{''.join(parts)})\\z"
