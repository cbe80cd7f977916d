"""Options of sources and flags of the command line: typed reads with defaults, durations and times."""

from __future__ import annotations

import os
import re
from datetime import datetime, timedelta, timezone
from typing import Any

#: Seconds of the units of a duration.
UNITS = {"ns": 1e-9, "us": 1e-6, "µs": 1e-6, "ms": 1e-3, "s": 1.0, "m": 60.0, "h": 3600.0}
_PART = r"(\d+\.?\d*|\.\d+)(ns|us|µs|ms|s|m|h)"


def duration(text: str) -> float | None:
    """Seconds of a duration like 90s, 1h30m or -2h; None if it isn't one."""
    if not re.fullmatch(rf"[+-]?({_PART})+|[+-]?0", text):
        return None
    seconds = sum(float(n) * UNITS[u] for n, u in re.findall(_PART, text))
    return -seconds if text[0] == "-" else seconds


def time_flag(text: str | None, now: datetime | None = None) -> datetime | None:
    """A time that a flag gives: so long ago ('36h'), RFC 3339, date and time, or a date; UTC unless it says otherwise."""
    if not text:
        return None
    if (ago := duration(text)) is not None:
        return (now or datetime.now(timezone.utc)) - timedelta(seconds=ago)
    if re.fullmatch(r"\d{4}-\d\d-\d\d(T\d\d:\d\d:\d\d((\.\d+)?(Z|[+-]\d\d:\d\d))?)?", text):
        at = datetime.fromisoformat(re.sub(r"(\.\d{6})\d+", r"\1", text))
        return at.astimezone(timezone.utc) if at.tzinfo else at.replace(tzinfo=timezone.utc)
    raise ValueError(f"no time: {text!r}")


def stamp_flag(text: str | None) -> str | None:
    """time_flag() as the 14 digits that file names have; 14 digits stay as they are."""
    if text and re.fullmatch(r"\d{14}", text):
        return text
    at = time_flag(text)
    return at.strftime("%Y%m%d%H%M%S") if at else None


class Options(dict[str, Any]):
    """A section of the configuration.  What is missing, null or of the wrong kind gives the default."""

    def text(self, key: str, default: str = "") -> str:
        """A value as text; ${NAME} is read from the environment."""
        v = self.get(key)
        if v is None:
            return default
        named = re.fullmatch(r"\$\{(.*)\}", str(v), re.DOTALL)
        return (os.environ.get(named[1]) or default) if named else str(v)

    def whole(self, key: str, default: int = 0) -> int:
        v = self.get(key)
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return int(v)
        return int(v) if isinstance(v, str) and re.fullmatch(r"\s*[+-]?[0-9]+\s*", v) else default

    def flag(self, key: str, default: bool = False) -> bool:
        v = self.get(key)
        return v if isinstance(v, bool) else {"1": True, "t": True, "true": True, "0": False, "f": False, "false": False}.get(str(v).lower(), default)

    def seconds(self, key: str, default: float = 0.0) -> float:
        found = duration(self.text(key))
        return default if found is None else found

    def texts(self, key: str) -> list[str]:
        """A list without blank entries; one value is a list of it."""
        v = self.get(key)
        items = v if isinstance(v, list) else [] if v is None else [v]
        return [s for x in items if (s := str(x).strip())]
