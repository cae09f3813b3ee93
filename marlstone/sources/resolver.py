"""Helpers for online catalogues: retries, an adaptive rate limit, and requests made once. Optional: the engine itself joins catalogue tables."""

from __future__ import annotations

import random
import re
import time
from collections import deque
from collections.abc import Callable, Iterable
from typing import Protocol

from pyspark.sql import DataFrame


class Resolver(Protocol):
    """Gives a frame of works its ids."""

    def resolve(self, works: DataFrame) -> DataFrame: ...


class RateLimited(RuntimeError):
    """The service keeps refusing."""


class Transient(RuntimeError):
    """Worth another try; retry_after: seconds that the service asked for."""

    def __init__(self, message: str, retry_after: float | None = None):
        super().__init__(message)
        self.retry_after = retry_after


def with_retry(call: Callable[[], object], *, tries: int = 4, base: float = 0.5, most: float = 30.0, sleep: Callable[[float], None] = time.sleep, rng: random.Random | None = None) -> object:
    """Call again after transient errors, with doubling waits and jitter, or as long as the service asked."""
    rng = rng or random.Random()
    for n in range(tries):
        try:
            return call()
        except Transient as e:
            if n == tries - 1:
                raise
            wait = min(most, base * 2**n) * (0.5 + rng.random() / 2)
            sleep(max(wait, e.retry_after or 0))
    raise AssertionError("tries is 1 or more")


class RateLimiter:
    """At most ``rate`` calls in ``window`` seconds. A refusal halves the rate down to ``floor``, a window without one raises it by a quarter; after
    ``patience`` refusals in a row the circuit opens for ``rest`` seconds."""

    def __init__(self, rate: int, *, window: float = 60.0, floor: int = 1, patience: int = 4, rest: float = 600.0, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.most, self.rate, self.window, self.floor, self.patience, self.rest = rate, rate, window, floor, patience, rest
        self._clock, self._sleep = clock, sleep
        self._calls: deque[float] = deque()
        self._refused, self._closed_until, self._clean_since = 0, 0.0, clock()

    def acquire(self) -> None:
        """Wait for a place; raises while the circuit is open."""
        if self._clock() < self._closed_until:
            raise RateLimited("the circuit is open")
        while True:
            now = self._clock()
            while self._calls and self._calls[0] <= now - self.window:
                self._calls.popleft()
            if now - self._clean_since >= self.window and self.rate < self.most:
                self.rate, self._clean_since = min(self.most, -(-self.rate * 5 // 4)), now
            if len(self._calls) < self.rate:
                self._calls.append(now)
                return
            self._sleep(max(0.0, self._calls[0] + self.window - now))

    def refused(self, retry_after: float | None = None) -> None:
        self._refused += 1
        self.rate = max(self.floor, self.rate // 2)
        self._clean_since = self._clock()
        if self._refused >= self.patience:
            self._closed_until, self._refused = self._clock() + self.rest, 0
            raise RateLimited("refused too often")
        self._sleep(retry_after if retry_after is not None else min(60.0, 2.0**self._refused))

    def accepted(self) -> None:
        self._refused = 0


def once(call: Callable[[str], object]) -> Callable[[str], object]:
    """``call`` with its results kept by argument; failures aren't kept."""
    done: dict[str, object] = {}

    def run(key: str) -> object:
        if key not in done:
            done[key] = call(key)
        return done[key]

    return run


def ordered_map(items: Iterable, workers: int, call: Callable) -> list:
    """Results in the order of the items, by at most ``workers`` threads; the first error ends it."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max(1, workers)) as pool:
        return list(pool.map(call, items))


def fetch_json(url: str, *, timeout: float = 15.0, headers: dict[str, str] | None = None, body: object = None) -> object:
    """GET, or POST of a JSON body, as JSON; 408, 425, 429 and 5xx are transient, and so is a network that fails."""
    import json
    import urllib.error
    import urllib.request

    try:
        data = None if body is None else json.dumps(body).encode()
        kind = {"Content-Type": "application/json", "Accept": "application/json"} if data else {"Accept": "application/json"}
        with urllib.request.urlopen(urllib.request.Request(url, data=data, headers=kind | (headers or {})), timeout=timeout) as r:  # noqa: S310
            return json.load(r)
    except urllib.error.HTTPError as e:
        hidden = re.sub(r"([?&](?:api_key|key|token)=)[^&]*", r"\1***", url)
        if e.code in (408, 425, 429) or e.code >= 500:
            wait = e.headers.get("Retry-After", "")
            raise Transient(f"{e.code} from {hidden}", float(wait) if wait.isdigit() else None) from e
        raise RuntimeError(f"{e.code} from {hidden}") from e
    except (urllib.error.URLError, TimeoutError, ConnectionError) as e:
        raise Transient(f"{type(e).__name__} from {url.split('?')[0]}") from e
