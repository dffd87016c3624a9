"""Remote reads on the driver: fingerprints, downloads with integrity, retries. The opener and the clock are injected."""

from __future__ import annotations

import hashlib
import os
import re
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from pathlib import Path

from postalith.plans.config import RETRY_AFTER_MOST, RETRY_CODES, RETRY_DELAYS, Source

CHUNK = 1 << 20
_MD5 = re.compile(r"\b([0-9a-fA-F]{32})\b")


class IntegrityError(RuntimeError):
    """What was read does not match its size or checksum."""


def delay(error: BaseException, attempt: int) -> float:
    """Seconds before the next attempt: what the server asks for up to a minute, else a fixed series."""
    asked = getattr(error, "headers", None) and error.headers.get("Retry-After")
    try:
        return min(RETRY_AFTER_MOST, max(0.0, float(asked)))
    except (TypeError, ValueError):
        return RETRY_DELAYS[min(attempt, len(RETRY_DELAYS) - 1)]


def retryable(error: BaseException) -> bool:
    if isinstance(error, urllib.error.HTTPError):
        return error.code in RETRY_CODES
    return isinstance(error, (urllib.error.URLError, ConnectionError, TimeoutError))


def retry(action: Callable, sleep: Callable[[float], None] = time.sleep):
    """The action's result; up to three attempts where the failure may pass."""
    for attempt in range(len(RETRY_DELAYS) + 1):
        try:
            return action()
        except Exception as error:
            if attempt == len(RETRY_DELAYS) or not retryable(error):
                raise
            sleep(delay(error, attempt))


def parse_md5(text: str) -> str:
    found = _MD5.search(text)
    if not found:
        raise IntegrityError("no md5 in the checksum file")
    return found[1].lower()


def fingerprint(source: Source, open_: Callable = urllib.request.urlopen, sleep: Callable[[float], None] = time.sleep) -> dict:
    """url, content_length, etag, last_modified and md5 of a remote file, without reading it."""

    def head() -> dict:
        with open_(urllib.request.Request(source.url, method="HEAD")) as r:
            return {k.lower(): v for k, v in r.headers.items()}

    def checksum() -> str:
        with open_(source.md5_url) as r:
            return r.read().decode("utf-8", "replace")

    headers = retry(head, sleep)
    length = int(headers.get("content-length") or 0)
    if length <= 0:
        raise IntegrityError(f"{source.name}: no content length")
    return {
        "metadata_key": source.metadata_key, "url": source.url, "content_length": length, "etag": headers.get("etag"),
        "last_modified": headers.get("last-modified"), "md5": parse_md5(retry(checksum, sleep)),
    }


def matches(path: Path, length: int, md5: str) -> bool:
    """Whether a file is there already, whole and right."""
    if not path.is_file() or path.stat().st_size != length:
        return False
    digest = hashlib.md5()
    with path.open("rb") as f:
        while part := f.read(CHUNK):
            digest.update(part)
    return digest.hexdigest() == md5


def download(seen: dict, path: Path, open_: Callable = urllib.request.urlopen, sleep: Callable[[float], None] = time.sleep) -> Path:
    """The file of a fingerprint; it appears under its name only when size and checksum are right."""
    if matches(path, seen["content_length"], seen["md5"]):
        return path
    part = path.with_name(path.name + ".part")

    def once() -> None:
        digest, size = hashlib.md5(), 0
        path.parent.mkdir(parents=True, exist_ok=True)
        with open_(seen["url"]) as r, part.open("wb") as f:
            while data := r.read(CHUNK):
                f.write(data)
                digest.update(data)
                size += len(data)
        if size != seen["content_length"] or digest.hexdigest() != seen["md5"]:
            raise IntegrityError(f"{seen['url']}: size or md5 differ")

    try:
        retry(once, sleep)
        os.replace(part, path)
    finally:
        part.unlink(missing_ok=True)
    return path
