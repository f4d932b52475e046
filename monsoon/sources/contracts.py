"""Contracts, feature lists, gates and pointers on the driver."""

from __future__ import annotations

import json
import os
import re
import tempfile
from pathlib import Path


class GateError(PermissionError):
    """A stage isn't authorised."""


def parse_yaml(text: str) -> object:
    """The subset of YAML that contracts use: nested maps, lists of scalars or maps, and plain or quoted scalars."""
    lines = [(len(x) - len(x.lstrip()), x.strip()) for x in (re.sub(r"(^|\s)#.*$", "", line).rstrip() for line in text.splitlines()) if x.strip()]
    value, rest = _block(lines, 0, lines[0][0]) if lines else ({}, 0)
    if lines and rest != len(lines):
        raise ValueError(f"odd indentation: {lines[rest][1]!r}")
    return value


def _scalar(text: str) -> object:
    if text[:1] in "\"'" and text[-1:] == text[:1] and len(text) > 1:
        return text[1:-1]
    if text.startswith("[") and text.endswith("]"):
        return [_scalar(x.strip()) for x in text[1:-1].split(",") if x.strip()]
    low = text.lower()
    if low in ("true", "false"):
        return low == "true"
    if low in ("null", "~", ""):
        return None
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return text


def _block(lines: list[tuple[int, str]], at: int, depth: int) -> tuple[object, int]:
    if lines[at][1].startswith("- "):
        items = []
        while at < len(lines) and lines[at][0] == depth and lines[at][1].startswith("- "):
            body = lines[at][1][2:].strip()
            if re.match(r"[\w.-]+:(\s|$)", body):
                inner = [(depth + 2, body), *lines[at + 1 :]]
                value, used = _block(inner, 0, depth + 2)
                at += used
            else:
                value, at = _scalar(body), at + 1
            items.append(value)
        return items, at
    out: dict[str, object] = {}
    while at < len(lines) and lines[at][0] == depth:
        key, _, body = lines[at][1].partition(":")
        at += 1
        if body.strip():
            out[key.strip().strip("\"'")] = _scalar(body.strip())
        elif at < len(lines) and (lines[at][0] > depth or (lines[at][0] == depth and lines[at][1].startswith("- "))):
            out[key.strip()], at = _block(lines, at, lines[at][0])
        else:
            out[key.strip()] = None
    return out, at


def read_contract(path: str | Path) -> dict:
    value = parse_yaml(Path(path).read_text(encoding="utf-8-sig"))
    if not isinstance(value, dict):
        raise ValueError("a contract is a map")
    return value


def overlay(base: dict, over: dict, sections: list[str]) -> dict:
    """base with whole sections of over in their place."""
    return base | {k: over[k] for k in sections if k in over}


def read_features(path: str | Path, key: str = "features") -> list[str]:
    """A selected list in order, without repeats; an empty one is an error."""
    found = list(dict.fromkeys(read_contract(path).get(key) or []))
    if not found:
        raise ValueError("the list of selected features is empty")
    return found


def write_features(path: str | Path, track: str, features: list[str], **ids: str) -> None:
    head = [f"track: {track}", *[f"{k}: {v}" for k, v in ids.items()], "features:"]
    Path(path).write_text("\n".join([*head, *[f"  - {f}" for f in features]]) + "\n", encoding="utf-8")


def require_gate(contract: dict, name: str) -> None:
    """Denies unless the gate says true."""
    if (contract.get("authorization") or {}).get(name) is not True:
        raise GateError(f"{name} is not authorised")


def publish(pointer: str | Path, value: dict) -> None:
    """Puts a pointer in place in one step."""
    target = Path(pointer)
    target.parent.mkdir(parents=True, exist_ok=True)
    with tempfile.NamedTemporaryFile("w", dir=target.parent, delete=False, encoding="utf-8") as file:
        json.dump(value, file, ensure_ascii=False, indent=2, default=str)
    os.replace(file.name, target)


def resolve(pointer: str | Path, **lineage: str) -> dict:
    """A pointer's run, which must have passed and be of the versions asked for."""
    value = json.loads(Path(pointer).read_text(encoding="utf-8"))
    if value.get("status") != "PASS":
        raise GateError(f"the run of {pointer} has not passed")
    wrong = {k: value.get(k) for k, v in lineage.items() if value.get(k) != v}
    if wrong:
        raise GateError(f"another lineage: {wrong}")
    return value
