"""A reader of damaged JSON objects: a stack of open objects and lists, closed at the end if nothing else closes them."""

from __future__ import annotations

import json
import re

_SPACE = re.compile(r"[\s,;]*")
_BARE = re.compile(r"[^\s,:{}\[\]\"'][^,:{}\[\]\n\"]*")
_NUMBER = re.compile(r"-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?")
_WORDS = {"true": True, "false": False, "null": None, "none": None}
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f"}
_HEX = re.compile(r"[0-9a-fA-F]{4}")


def _string(text: str, at: int) -> tuple[str, int]:
    """The string that the quote at `at` opens, and where it ends: at the same quote, or at the end of the text."""
    quote, out, at = text[at], [], at + 1
    while at < len(text) and text[at] != quote:
        if text[at] == "\\" and at + 1 < len(text):
            at += 1
            if text[at] == "u" and _HEX.match(text, at + 1):
                out.append(chr(int(text[at + 1 : at + 5], 16)))
                at += 4
            else:
                out.append(_ESCAPES.get(text[at], text[at]))
        else:
            out.append(text[at])
        at += 1
    return "".join(out), at + 1


def read(text: str) -> dict | None:
    """The first object of the text, or None without one or if it is empty. Single quotes, bare keys and words, missing and doubled commas, missing colons' values (null) and missing ends are borne."""
    at = text.find("{")
    if at < 0:
        return None
    root: dict = {}
    stack: list[dict | list] = [root]
    keys: list[str | None] = [None]  # of each open container the key that waits for its value
    at += 1

    def put(value) -> None:
        if isinstance(stack[-1], list):
            stack[-1].append(value)
        elif keys[-1] is None:
            keys[-1] = value if isinstance(value, str) else json.dumps(value)
        else:
            stack[-1][keys[-1]] = value
            keys[-1] = None

    def close() -> None:
        if keys[-1] is not None:
            stack[-1][keys[-1]] = None
        stack.pop()
        keys.pop()

    while stack and (at := _SPACE.match(text, at).end()) < len(text):
        c = text[at]
        if c in "{[":
            new: dict | list = {} if c == "{" else []
            if c == "{" and isinstance(stack[-1], dict) and keys[-1] is None:
                at += 1  # an object where a key should be
                continue
            put(new) if isinstance(stack[-1], list) or keys[-1] is not None else None
            stack.append(new)
            keys.append(None)
            at += 1
        elif c in "}]":
            if isinstance(stack[-1], dict) == (c == "}"):
                close()
            elif any(isinstance(s, dict) == (c == "}") for s in stack):
                while isinstance(stack[-1], dict) != (c == "}"):
                    close()
                close()
            at += 1
        elif c == ":":
            at += 1
        elif c in "\"'":
            value, at = _string(text, at)
            put(value)
        else:
            word = _BARE.match(text, at)
            raw, at = word.group().strip(), word.end()
            if isinstance(stack[-1], dict) and keys[-1] is None:
                put(raw)
            elif _NUMBER.fullmatch(raw):
                put(json.loads(raw))
            else:
                put(_WORDS.get(raw.lower(), raw))
    while stack:
        close()
    return root or None


def repaired(text: str | None) -> str | None:
    """The object of a damaged text as JSON text, or None; so it is for one nested deeper than JSON is written here."""
    found = read(text or "")
    try:
        return None if found is None else json.dumps(found, ensure_ascii=False).encode("utf-8", "replace").decode()
    except RecursionError:
        return None
