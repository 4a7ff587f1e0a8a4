"""What an answer of a language model holds as JSON, cut off or not."""

from __future__ import annotations

import json
import re

SPACE = re.compile(r"[ \t\r\n]*")


def whole_pairs(text: str) -> dict | None:
    """The pairs of the object that begins at the first brace, up to the last one that a comma or its brace ends."""
    read, found, done = json.JSONDecoder(), {}, False
    at, n = text.find("{"), len(text)
    space = lambda i: SPACE.match(text, i).end()
    at = space(at + 1) if at >= 0 else n
    try:
        while at < n and text[at] == '"':
            key, at = read.raw_decode(text, at)
            at = space(at)
            if at >= n or text[at] != ":":
                break
            value, at = read.raw_decode(text, space(at + 1))
            at = space(at)
            if at >= n or text[at] not in ",}":  # what is cut may have gone on
                break
            found[key], done = value, True
            if text[at] == "}":
                break
            at = space(at + 1)
    except ValueError:
        pass
    return found if done else None


def answer(text: str | None) -> str | None:
    """The JSON of an answer's last readable fenced block, of the answer itself, or of the whole pairs before a cut."""
    if text is None:
        return None
    bare = text.strip()
    for block in [*reversed(re.findall(r"```(?:json)?[ \t\r]*\n(.*?)```", text, re.S)), *([bare] if bare.startswith("{") else [])]:
        try:
            return json.dumps(json.loads(block))
        except ValueError:
            continue
    pairs = whole_pairs(text[max(0, text.rfind("```json")) :])
    return None if pairs is None else json.dumps(pairs)
