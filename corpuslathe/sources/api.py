"""A paged HTTP API as a batch source: requests with a byte limit, retries and pacing, landed as files page-N.json.

Fetching is bounded by the API, not by data: it runs at the driver, one page after the other, since each page names the next. What is
landed is read by `corpuslathe.sources.pages`, in batch or as a stream. A run that was stopped goes on after its last page.
"""

from __future__ import annotations

import json
import os
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable

#: Statuses worth another attempt.
RETRY = {408, 425, 429, 500, 502, 503, 504}


def fetch(url: str, timeout: float = 120, max_bytes: int = 30_000_000, attempts: int = 4, base_delay: float = 1.0, max_delay: float = 8.0, opener: Callable = urllib.request.urlopen, sleep: Callable = time.sleep) -> str:
    """The body as text, undecodable bytes replaced; raises after the last attempt, or at once where another one can't help."""
    for n in range(1, attempts + 1):
        try:
            with opener(url, timeout=timeout) as r:
                body = r.read(max_bytes + 1)
                if len(body) > max_bytes:
                    raise ValueError(f"more than {max_bytes} bytes")
                return body.decode((r.headers.get_content_charset() if r.headers else None) or "utf-8", "replace")
        except urllib.error.HTTPError as e:
            if e.code not in RETRY or n == attempts:
                raise
        except (urllib.error.URLError, TimeoutError):
            if n == attempts:
                raise
        sleep(min(max_delay, base_delay * 2 ** (n - 1)))
    raise AssertionError


def land(base: str, folder: str, query: dict[str, str], max_pages: int | None = None, pause: float = 1.0, get: Callable[[str], str] = fetch, sleep: Callable = time.sleep) -> tuple[int, bool]:
    """(pages landed now, complete): follows cursors from the last page that is there; a repeated cursor, or an empty page with one, is an error."""
    os.makedirs(folder, exist_ok=True)
    done, seen, cursor, complete = 0, set(), None, False
    page = 1
    while os.path.exists(name := f"{folder}/page-{page:06d}.json"):
        cursor, complete = _next(open(name, encoding="utf-8").read(), seen, cursor)
        page += 1
    while not complete and (max_pages is None or done < max_pages):
        url = f"{base}?{urllib.parse.urlencode(query | ({'cursor': cursor} if cursor is not None else {}))}"
        if done:
            sleep(pause)
        raw = get(url)
        cursor, complete = _next(raw, seen, cursor)
        with open(f"{folder}/.page.tmp", "w", encoding="utf-8") as f:
            f.write(raw)
        os.replace(f"{folder}/.page.tmp", f"{folder}/page-{page:06d}.json")
        page, done = page + 1, done + 1
    return done, complete


def _next(raw: str, seen: set, asked: object) -> tuple[object, bool]:
    doc = json.loads(raw)
    if not isinstance(doc, dict) or not isinstance(doc.get("items"), list):
        raise ValueError("a page must be an object with a list of items")
    c = doc.get("cursor")
    if c == "":
        c = None
    if isinstance(c, (bool, dict, list)):
        raise ValueError("the cursor must be a string, a number or null")
    if c is None:
        return None, True
    if c == asked or (type(c).__name__, c) in seen:
        raise ValueError("the API returned a cursor again")
    if not doc["items"]:
        raise ValueError("an empty page with a cursor")
    seen.add((type(c).__name__, c))
    return c, False
