"""Paid calls at most once: a ledger of requests, written before and after each call.

A task claims a request before it calls, and settles it with the answer. A task that Spark repeats finds the answer and doesn't call
again. Where an earlier attempt claimed and never settled, nobody knows whether the service has charged: the request isn't sent again, gives
nothing, and is told of by unsettled(), to be settled or released by hand.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path
from typing import Protocol

OPEN = "open"


def key_of(url: str, payload: dict) -> str:
    """Equal requests have equal keys, whatever the order of their fields."""
    return hashlib.sha256(json.dumps([url, payload], sort_keys=True, ensure_ascii=False).encode()).hexdigest()


class Ledger(Protocol):
    """Where requests are written down; claims of one key by several tasks must leave one that got it."""

    def claim(self, key: str, request: dict) -> dict | str | None:
        """None if the caller has it now, the answer if it was settled, OPEN if another attempt has it."""

    def settle(self, key: str, answer: dict) -> None: ...

    def release(self, key: str) -> None: ...


@dataclass(frozen=True)
class FolderLedger:
    """Requests as files of a folder that is mounted under one path on all machines; creating and renaming are atomic there."""

    folder: str

    def _path(self, key: str, kind: str) -> Path:
        return Path(self.folder) / key[:2] / f"{key}.{kind}"

    def claim(self, key: str, request: dict) -> dict | str | None:
        claimed, settled = self._path(key, "claim"), self._path(key, "answer")
        claimed.parent.mkdir(parents=True, exist_ok=True)
        try:
            handle = os.open(claimed, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
        except FileExistsError:
            return json.loads(settled.read_text()) if settled.exists() else OPEN
        with os.fdopen(handle, "w") as f:
            json.dump(request, f)
        return None

    def settle(self, key: str, answer: dict) -> None:
        draft = self._path(key, f"draft-{os.getpid()}")
        draft.write_text(json.dumps(answer))
        draft.replace(self._path(key, "answer"))

    def release(self, key: str) -> None:
        self._path(key, "claim").unlink(missing_ok=True)

    def unsettled(self) -> list[dict]:
        """Requests that were claimed and never settled."""
        return [json.loads(p.read_text() or "{}") for p in sorted(Path(self.folder).glob("*/*.claim")) if not p.with_suffix(".answer").exists()]


def at_most_once(ledger: Ledger | None, send: Callable[[str, str, dict], dict], url: str, payload: dict, refused: type[Exception]) -> tuple[dict, bool]:
    """The answer to a request, and whether it was paid for now. A call that the service refused is released, to be tried again."""
    if ledger is None:
        return send("POST", url, payload), True
    key = key_of(url, payload)
    before = ledger.claim(key, {"url": url, "payload": payload})
    if before is not None:
        return ({} if before == OPEN else before), False
    try:
        answer = send("POST", url, payload)
    except refused as e:
        if getattr(e, "status", None) is not None:  # the service answered, so it hasn't charged; without an answer nobody knows
            ledger.release(key)
        raise
    ledger.settle(key, answer)
    return answer, True
