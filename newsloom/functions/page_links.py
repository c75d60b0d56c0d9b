"""Link resolution inside the page-reading job; same rule as ``urls.resolve``."""

from __future__ import annotations

import re
from urllib.parse import quote

_PARTS = re.compile(r"(?:([a-zA-Z][a-zA-Z0-9+.-]*):)?(//[^/?#]*)?([^?#]*)(.*)", re.S)
_BAD_ESCAPE = re.compile(r"%(?![0-9a-fA-F]{2})")
_CONTROL = re.compile(r"[\x00-\x1f\x7f]")
_NON_ASCII = re.compile(r"[^\x00-\x7f]+")


def without_dot_segments(path: str) -> str:
    segments = path[1:].split("/")
    done: list[str] = []
    for s in segments:
        if s == "..":
            del done[-1:]
        elif s != ".":
            done.append(s)
    if segments[-1] in (".", ".."):
        done.append("")
    return "/" + "/".join(done)


def resolve_link(base: str, ref: str) -> str:
    """Absolute form of ``ref``; raises ``ValueError`` when it is no URL."""
    ref = ref.strip(" \t\n\f\r")
    path_part = re.split(r"[?#]", ref, maxsplit=1)[0]
    if _CONTROL.search(ref) or _BAD_ESCAPE.search(path_part) or ref.startswith(":"):
        raise ValueError(f"malformed link {ref!r}")
    base_scheme, base_host, base_path, base_tail = _PARTS.match(base.split("#", 1)[0]).groups()
    scheme, host, path, tail = _PARTS.match(ref).groups()
    origin = f"{base_scheme}:{base_host or ''}"
    if scheme and not host:
        absolute = ref
    elif host:
        clean = without_dot_segments(path) if path.startswith("/") else path
        absolute = f"{scheme or base_scheme}:{host}{clean}{tail}"
    elif path.startswith("/"):
        absolute = origin + without_dot_segments(path) + tail
    elif path:
        merged = (base_path[: base_path.rfind("/") + 1] or "/") + path
        absolute = origin + without_dot_segments(merged) + tail
    elif tail.startswith("?"):
        absolute = origin + base_path + tail
    else:
        absolute = origin + base_path + base_tail + tail
    return _NON_ASCII.sub(lambda m: quote(m[0]), absolute)
