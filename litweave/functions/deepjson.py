"""JSON texts of any depth: the standard reader and writer, and where these run out of stack, loops that keep their own."""

from __future__ import annotations

import json
import re
from json.decoder import scanstring

DECODER = json.JSONDecoder()
BLANK = re.compile(r"[ \t\n\r]*")
NUMBER = re.compile(r"(-?(?:0|[1-9]\d*))(\.\d+)?([eE][-+]?\d+)?")
WORDS = {"true": True, "false": False, "null": None, "NaN": float("nan"), "Infinity": float("inf"), "-Infinity": float("-inf")}


def loads(text: str) -> object:
    """The value of a JSON text; ValueError if it is none."""
    try:
        return json.loads(text)
    except RecursionError:
        value, end = walked(text, BLANK.match(text).end())
        if BLANK.match(text, end).end() != len(text):
            raise ValueError("more follows the value") from None
        return value


def raw_decode(text: str, at: int) -> tuple[object, int]:
    """The value that begins at a place, and where it ends."""
    try:
        return DECODER.raw_decode(text, at)
    except RecursionError:
        return walked(text, at)


def walked(text: str, at: int) -> tuple[object, int]:
    """The same by a loop: open containers are kept in a list, each object with the key it waits to fill."""
    open_: list[tuple[dict | list, str | None]] = []
    size = len(text)

    def blank(i: int) -> int:
        return BLANK.match(text, i).end()

    def key_at(i: int) -> tuple[str, int]:
        if i >= size or text[i] != '"':
            raise ValueError(f"no key at {i}")
        key, i = scanstring(text, i + 1, True)
        i = blank(i)
        if i >= size or text[i] != ":":
            raise ValueError(f"no colon at {i}")
        return key, blank(i + 1)

    while True:
        if at >= size:
            raise ValueError("the text ends within a value")
        c = text[at]
        if c in "{[":
            box: dict | list = {} if c == "{" else []
            at = blank(at + 1)
            if at < size and text[at] == ("}" if c == "{" else "]"):
                value, at = box, at + 1
            else:
                key = None
                if c == "{":
                    key, at = key_at(at)
                open_.append((box, key))
                continue
        elif c == '"':
            value, at = scanstring(text, at + 1, True)
        elif m := NUMBER.match(text, at):
            whole, fraction, power = m.groups()
            value = float(m.group()) if fraction or power else int(whole)
            at = m.end()
        else:
            word = next((w for w in WORDS if text.startswith(w, at)), None)
            if word is None:
                raise ValueError(f"no value at {at}")
            value, at = WORDS[word], at + len(word)
        while open_:  # the value is whole: it goes into what is open, which may be whole then too
            box, key = open_.pop()
            if isinstance(box, dict):
                box[key] = value
            else:
                box.append(value)
            at = blank(at)
            end = "}" if isinstance(box, dict) else "]"
            if at < size and text[at] == ",":
                at, key = blank(at + 1), None
                if isinstance(box, dict):
                    key, at = key_at(at)
                open_.append((box, key))
                break
            if at >= size or text[at] != end:
                raise ValueError(f"neither a comma nor an end at {at}")
            value, at = box, at + 1
        else:
            return value, at


def dumps(value: object, sort_keys: bool = False) -> str:
    """The text of a value, not escaped to ASCII."""
    try:
        return json.dumps(value, ensure_ascii=False, sort_keys=sort_keys)
    except RecursionError:
        out: list[str] = []
        todo: list = [value]
        while todo:
            v = todo.pop()
            if isinstance(v, Piece):
                out.append(v)
            elif isinstance(v, dict) and v:
                items = sorted(v.items()) if sort_keys else list(v.items())
                todo.append(Piece("}"))
                for i in range(len(items) - 1, -1, -1):
                    k, x = items[i]
                    todo += [x, Piece((", " if i else "{") + json.dumps(k, ensure_ascii=False) + ": ")]
            elif isinstance(v, list) and v:
                todo.append(Piece("]"))
                for i in range(len(v) - 1, -1, -1):
                    todo += [v[i], Piece(", " if i else "[")]
            else:
                out.append(json.dumps(v, ensure_ascii=False))
        return "".join(out)


class Piece(str):
    """Text of its own among values still to be written."""
