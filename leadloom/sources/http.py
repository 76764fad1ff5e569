"""JSON over HTTPS, with tries again where a service asks for patience. Opening and waiting are parameters, so tests call nothing."""

from __future__ import annotations

import json
import ssl
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

TIMEOUT = 45
#: Status that means: later again; and seconds before the second and the third try.
BUSY, WAITS = 429, (2, 4)


class RequestFailed(Exception):
    """A service couldn't be reached, or rejected a call; status is None where there was no answer."""

    def __init__(self, said: str, status: int | None = None) -> None:
        super().__init__(said, status)
        self.said, self.status = said, status

    def __str__(self) -> str:
        return self.said


def trust() -> ssl.SSLContext:
    """The system's certificates, or those of certifi where the system has none. Verification is never weakened."""
    own = ssl.create_default_context()
    if not own.get_ca_certs():
        try:
            import certifi
        except ImportError:
            return own
        own.load_verify_locations(certifi.where())
    return own


def over_network(request: urllib.request.Request) -> bytes:
    with urllib.request.urlopen(request, timeout=TIMEOUT, context=trust()) as answer:
        return answer.read()


@dataclass(frozen=True)
class JsonClient:
    """Calls (method, url, payload) with fixed headers. patient: whether busy services and lost connections are tried again."""

    headers: Mapping[str, str] = field(default_factory=dict)
    patient: bool = False
    open_: Callable[[urllib.request.Request], bytes] = over_network
    wait: Callable[[float], None] = time.sleep

    def __call__(self, method: str, url: str, payload: dict | None = None) -> dict:
        waits = iter(WAITS if self.patient else ())
        while True:
            try:
                return self.once(method, url, payload)
            except RequestFailed as e:
                pause = next(waits, None) if e.status in (None, BUSY) else None
                if pause is None:
                    raise
                self.wait(pause)

    def once(self, method: str, url: str, payload: dict | None) -> dict:
        sent = {"Accept": "application/json", **self.headers}
        body = None
        if payload is not None:
            sent["Content-Type"], body = "application/json", json.dumps(payload).encode()
        try:
            text = self.open_(urllib.request.Request(url, data=body, method=method, headers=sent))
        except urllib.error.HTTPError as e:
            raise RequestFailed(f"{method} {url}: {e.code} {_message(e.read())}", e.code) from e
        except urllib.error.URLError as e:
            raise RequestFailed(f"{method} {url}: {e.reason}") from e
        return json.loads(text) if text else {}


def _message(body: bytes) -> str:
    """What an error's body says, its message if it is JSON that has one."""
    text = body.decode(errors="replace")
    try:
        said = json.loads(text)
    except ValueError:
        return text
    return str(said.get("message") or text) if isinstance(said, dict) else text
