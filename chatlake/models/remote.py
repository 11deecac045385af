"""An embedder that asks a service over HTTP, and where its key is found."""

from __future__ import annotations

import json
import os
import time
import urllib.error
import urllib.request
from dataclasses import dataclass

from chatlake.models.embedder import TooLong


def find_key(paths: list[str], variable: str | None = None) -> str:
    """The key in the first of the files that is there, else in an environment variable; an error if there is none."""
    for p in paths:
        if os.path.isfile(p):
            with open(p) as f:
                return f.read().strip()
    key = os.environ.get(variable, "").strip() if variable else ""
    if not key:
        raise LookupError(f"no key in {paths} or {variable}")
    return key


@dataclass
class HttpEmbedder:
    """Posts {"model", "input"} and reads {"data": [{"embedding"}]}. The key is looked up on the worker, so it does not
    travel with the plan; `pause` seconds lie between calls. A refusal for length is TooLong; other failures are raised
    after `tries` attempts, with growing pauses where the service is busy."""

    url: str
    name: str
    dims: int
    key_paths: tuple[str, ...] = ()
    key_variable: str | None = None
    pause: float = 0.0
    tries: int = 3
    timeout: float = 60.0

    def embed(self, texts: list[str]) -> list[list[float]]:
        body = json.dumps({"model": self.name, "input": texts}).encode()
        for attempt in range(self.tries):
            headers = {"Content-Type": "application/json", "Authorization": f"Bearer {find_key(list(self.key_paths), self.key_variable)}"}
            try:
                with urllib.request.urlopen(urllib.request.Request(self.url, body, headers), timeout=self.timeout) as r:
                    rows = sorted(json.load(r)["data"], key=lambda x: x.get("index", 0))
                time.sleep(self.pause)
                return [x["embedding"] for x in rows]
            except urllib.error.HTTPError as e:
                said = e.read().decode("utf-8", "replace")
                if e.code in (400, 413) and ("maximum context length" in said or "token" in said.lower()):
                    raise TooLong(said[:200]) from e
                if e.code not in (429, 500, 502, 503) or attempt + 1 == self.tries:
                    raise
                time.sleep(min(30.0, self.pause + 2.0**attempt / 10))
        raise AssertionError
