"""Operator 9: URL rules in a sorted array of digests.

A rule is a host and a path; its string's 64-bit xxhash is a key of a sorted array in a file, with the
rule strings behind it.  Executors get the file from Spark, map it into memory and probe it for
a batch of urls at once by binary search; a hit counts when the stored string is the same.
"""

from __future__ import annotations

import bisect
import functools
import json
import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from paysieve.llm import shared

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class DigestArray:
    """The keys, strings and verdicts of rules in one file: a line of JSON, then the arrays."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            head = json.loads(f.readline())
            at = f.tell()
        n = head["rules"]
        self.path_lengths, self.longest_host = head["path_lengths"], head["longest_host"]
        data = np.memmap(path, dtype=np.uint8, mode="r") if n else np.zeros(0, np.uint8)
        self.keys = data[at : at + 8 * n].view("<u8")
        self.edges = data[at + 8 * n : at + 16 * n + 8].view("<u8")
        self.block = data[at + 16 * n + 8 : at + 17 * n + 8]
        self.text = data[at + 17 * n + 8 :]

    @staticmethod
    def write(path: str, rules: Iterable[tuple[str, str, str]]) -> None:
        """rules: verdict, host, path.  Of equal rules the last stands."""
        of = {(host.translate(_LOWER) + where).encode(): (verdict == "block", len(host), len(where)) for verdict, host, where in rules}
        own = sorted((xxhash.xxh64_intdigest(s), s, block) for s, (block, *_) in of.items())
        with open(path, "wb") as f:
            head = json.dumps({"rules": len(own), "path_lengths": sorted({k for *_, k in of.values()}), "longest_host": max((h for _, h, _ in of.values()), default=0)})
            size = len(head) + 1
            f.write((head + " " * (-size % 8) + "\n").encode())
            if own:
                f.write(np.array([k for k, _, _ in own], "<u8").tobytes())
                f.write(np.cumsum([0, *(len(s) for _, s, _ in own)]).astype("<u8").tobytes())
                f.write(np.array([b for _, _, b in own], "u1").tobytes())
                f.write(b"".join(s for _, s, _ in own))

    def find(self, strings: list[bytes]) -> np.ndarray:
        """The place of each string, -1 if it is not there."""
        keys = np.fromiter(map(xxhash.xxh64_intdigest, strings), dtype=np.uint64, count=len(strings))
        low, high = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        out = np.full(len(strings), -1, dtype=np.int64)
        for i in np.flatnonzero(low < high).tolist():
            for k in range(int(low[i]), int(high[i])):
                if self.string(k) == strings[i]:
                    out[i] = k
        return out

    def string(self, k: int) -> bytes:
        return self.text[int(self.edges[k]) : int(self.edges[k + 1])].tobytes()


@functools.lru_cache(maxsize=4)
def _opened(name: str) -> DigestArray:
    return DigestArray(SparkFiles.get(name))


def host_and_path(url: str | None) -> tuple[str, str]:
    """The host after the first ``://``, in lower case, and the path up to ``?`` or ``#``; both empty without ``://``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    path = rest[end:]
    stop = min((i for i in map(path.find, "?#") if i >= 0), default=len(path))
    return rest[:end].translate(_LOWER), path[:stop]


def candidates(host: str, path: str, path_lengths: list[int], longest_host: int) -> list[str]:
    """Every string that a rule for this url can have, the longest first; no rule's host is longer than ``longest_host``."""
    if not host:
        return []
    first = max(0, len(host) - longest_host)
    labels = [host[i:] for i in range(first, len(host)) if i == 0 or host[i - 1] == "."]
    fit = path_lengths[: bisect.bisect_right(path_lengths, len(path))]
    return sorted((h + path[:k] for h in labels for k in fit), key=lambda s: (-len(s), s))


def _verdicts(array: DigestArray, parts: list[tuple[str, str]], default: str, at_once: int = 1 << 15) -> Iterator[tuple[str | None, str]]:
    """Rule and verdict of each host and path; about ``at_once`` strings are probed together, whatever the rules' path lengths."""
    waiting: list[list[str]] = []

    def settled() -> Iterator[tuple[str | None, str]]:
        hits, at = array.find([s.encode() for own in waiting for s in own]), 0
        for own in waiting:
            found = np.flatnonzero(hits[at : at + len(own)] >= 0)
            yield (own[found[0]], "block" if array.block[hits[at + found[0]]] else "allow") if len(found) else (None, default)
            at += len(own)
        waiting.clear()

    strings = 0
    for host, path in parts:
        waiting.append(candidates(host, path, array.path_lengths, array.longest_host))
        strings += len(waiting[-1])
        if strings >= at_once:
            yield from settled()
            strings = 0
    yield from settled()


def judge_urls(urls: DataFrame, rules: list[tuple[str, str, str]], *, default: str = "allow", url_col: str = "url", keep: tuple[str, ...] = ("page_id",), most_bytes: int = 1 << 30) -> DataFrame:
    """host, path, rule and verdict of every url, beside the columns of ``keep``.

    rules: (block or allow, host, path).  A rule fits its host and all subdomains if the url's path starts
    with the rule's path.  The longest fitting rule wins; of two as long, the first in string order.  Urls
    that no rule fits get ``default``.  A null url, or one without ``://``, has an empty host and path and
    fits no rule.  Repeated rows stay.  Urls of any length are read whole: only host endings as long as a rule's
    are tried.  An empty table gives no rows, no rules give ``default`` throughout.  A column of ``keep`` that has a
    new one's name gives way to it.

    The array is sent to each executor once as a file; a list of over ``most_bytes`` is refused, and so is a rule without a
    host or a path.
    """
    spark = urls.sparkSession
    if any(host is None or where is None for _, host, where in rules):
        raise ValueError("a rule has no host or no path")
    folder = tempfile.mkdtemp(prefix="paysieve-")
    name = f"rules-{uuid.uuid4().hex}.bin"
    path = os.path.join(folder, name)
    DigestArray.write(path, rules)
    if os.path.getsize(path) > most_bytes:
        raise ValueError(f"the rules take over {most_bytes} bytes")
    spark.sparkContext.addFile(path)

    new = ("host", "path", "rule", "verdict")
    keep = tuple(k for k in keep if k.lower() not in new)
    own_url = shared.new_name("own_url", [*keep, *new])

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = _opened(name)
        for batch in (part for whole in batches for part in shared.slices(whole, own_url)):
            parts = [host_and_path(u) for u in batch.column(own_url).to_pylist()]
            rules_out, verdicts = zip(*_verdicts(array, parts, default), strict=True)
            columns = [pa.array([h for h, _ in parts], pa.string()), pa.array([p for _, p in parts], pa.string()), pa.array(rules_out, pa.string()), pa.array(verdicts, pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), *columns], [*keep, *new])

    from pyspark.sql import types as T

    rows = urls.select(*keep, urls[url_col].alias(own_url))
    schema = T.StructType([*(urls.schema[k] for k in keep), *(T.StructField(c, T.StringType()) for c in new)])
    return rows.mapInArrow(judged, schema)


SQL = """
WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw_host, rest FROM cut),
named AS (SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path FROM parts),
ruled AS (SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM named)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.com/de/', 'net/') THEN 'block' ELSE 'allow' END AS verdict FROM ruled
"""
