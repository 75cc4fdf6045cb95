"""PHP-serialized text → JSON text, one value at a time (the per-row helper).

Grammar (all lengths in **bytes** of the UTF-8 encoding)::

    value := 'N;' | 'b:' int ';' | 'i:' int ';' | 'd:' float ';'
           | 's:' len ':"' <len bytes> '";'
           | 'a:' count ':{' (value value){count} '}'

Decoding rules the output must follow:

* every array becomes a JSON object (list indices become string keys);
  a later duplicate key overwrites the earlier value in place;
* numbers are parsed with Python's ``int``/``float`` (so ``d:3;`` → ``3.0``);
* string lengths count bytes; each string is decoded as UTF-8 (for text
  input a byte-length slice between its quotes always decodes, so the
  ``{"error": "key conversion failed"}`` subtree of a failed decode cannot
  arise from a string column);
* objects (``O:``) are not supported and, like any other failure, make the
  whole value ``{"error": "<message>"}``;
* bytes after the first complete value are ignored;
* output uses ``json.dumps`` defaults: ``", "`` / ``": "`` separators and
  non-ASCII escaped as ``\\uXXXX``.

Top level: null or empty → ``""``; text not starting with one of the gate
prefixes is returned unchanged.
"""

from __future__ import annotations

import json
import math
import re

# The prefixes that mark a value as serialized (case-sensitive).
GATE_PREFIXES = ("a:", "s:", "i:", "d:", "O:", "b:", "N;")
# The same gate as a Java regex, for the JVM side.
GATE_REGEX = r"^(?:[asidOb]:|N;)"

# Up to this nesting ``json.dumps`` writes the value; deeper values are written without recursion.
JSON_DEPTH = 100


class _Bad(ValueError):
    pass


# One token header per match: ``s:<len>:`` / ``a:<count>:`` (group 1, 2),
# ``i:<n>;`` / ``d:<x>;`` / ``b:<n>;`` (group 3, 4), or ``N;`` (group 5).
# Type letters are case-insensitive below the top level.
_TOKEN = re.compile(rb"([sa]):([^:]*):|([idb]):([^;]*);|(n);", re.IGNORECASE)
_QUOTE, _SEMI, _OPEN, _CLOSE = 0x22, 0x3B, 0x7B, 0x7D


_match = _TOKEN.match


def _scalar(buf: bytes, pos: int):
    """One token at ``pos``: (value, next position, None), or for an array (None, position of its first
    element, its number of pairs)."""
    m = _match(buf, pos)
    if m is None:
        if buf[pos:pos + 1] in (b"O", b"o"):
            raise _Bad("objects are not supported")
        raise _Bad(f"malformed value at byte {pos}")
    end = m.end()
    kind = m.lastindex  # 2: s/a header, 4: i/d/b scalar, 5: null
    if kind == 4:
        op, raw = m.group(3, 4)
        if op in b"iI":
            return int(raw), end, None
        if op in b"dD":
            return float(raw), end, None
        return int(raw) != 0, end, None
    if kind == 5:
        return None, end, None
    op, raw = m.group(1, 2)
    size = int(raw)
    if op in b"sS":
        stop = end + 1 + size
        if size < 0 or stop + 2 > len(buf):
            raise _Bad(f"string length {size} out of range")
        if buf[end] != _QUOTE or buf[stop] != _QUOTE or buf[stop + 1] != _SEMI:
            raise _Bad(f"string of length {size} at byte {pos} is not delimited")
        # The slice sits between two ASCII quotes, i.e. on character
        # boundaries of the (valid) UTF-8 input, so it always decodes.
        return buf[end + 1:stop].decode("utf-8"), stop + 2, None
    if end >= len(buf) or buf[end] != _OPEN:
        raise _Bad(f"expected '{{' at byte {end}")
    return None, end + 1, max(0, size)


def _parse(buf: bytes, pos: int):
    """Parse one value at ``pos``; (value, deepest nesting). Open arrays are on a list, not on the call
    stack, so nesting has no limit."""
    open_: list[list] = []  # [dict, pairs still to come, key or _NO_KEY]
    deepest = 0
    while True:
        value, pos, pairs = _scalar(buf, pos)
        if pairs is not None:
            value = {}
            if pairs:
                open_.append([value, pairs, _NO_KEY])
                deepest = max(deepest, len(open_))
                continue
            pos = _closed(buf, pos)
            deepest = max(deepest, len(open_) + 1)
        while open_:  # the value is the key or the value of the innermost array's pair
            top = open_[-1]
            if top[2] is _NO_KEY:
                hash(value)  # an array as a key raises TypeError
                top[2] = value
                break
            top[0][top[2]] = value
            top[2], top[1] = _NO_KEY, top[1] - 1
            if top[1]:
                break
            pos = _closed(buf, pos)
            value = open_.pop()[0]
        else:
            return value, deepest


_NO_KEY = object()


def _closed(buf: bytes, pos: int) -> int:
    if pos >= len(buf) or buf[pos] != _CLOSE:
        raise _Bad(f"expected '}}' at byte {pos}")
    return pos + 1


def _json(value, strict: bool) -> str:
    """``json.dumps`` of nested dicts without recursion."""
    out, todo = [], [value]
    while todo:
        item = todo.pop()
        if isinstance(item, _Text):
            out.append(item)
        elif not isinstance(item, dict):
            out.append("null" if strict and isinstance(item, float) and not math.isfinite(item) else json.dumps(item))
        else:
            todo.append(_Text("}"))
            pairs = list(item.items())
            for k in range(len(pairs) - 1, -1, -1):
                key = json.dumps({pairs[k][0]: 0})[1:-2]  # the key as an object key, with its separator
                todo += [pairs[k][1], _Text((", " if k else "") + key)]
            out.append("{")
    return "".join(out)


class _Text(str):
    """Finished output."""


def _finite(value):
    if isinstance(value, float) and not math.isfinite(value):
        return None
    if isinstance(value, dict):
        return {k: _finite(v) for k, v in value.items()}
    return value


def decode(text: str):
    """Parse serialized text into Python values (str keys/values). Raises on failure."""
    return _parse(text.encode("utf-8"), 0)[0]


def php_to_json(text: str | None, strict_json: bool = False) -> str:
    """The full column rule for one value (see module docstring)."""
    if not text:
        return ""
    if not text.startswith(GATE_PREFIXES):
        return text
    return serialized_to_json(text, strict_json)


def serialized_to_json(text: str, strict_json: bool = False) -> str:
    """JSON for text already known to pass the gate; failures give an error object."""
    try:
        value, depth = _parse(text.encode("utf-8"), 0)
        if depth > JSON_DEPTH:
            return _json(value, strict_json)
        return json.dumps(_finite(value) if strict_json else value)
    except Exception as exc:  # noqa: BLE001 — any failure is reported in-band
        return json.dumps({"error": str(exc)})
