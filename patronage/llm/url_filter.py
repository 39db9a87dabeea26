"""URL filter: all glob rules run at once as one bit-parallel automaton over each canonical URL.

A glob is packed into bits of a multiword mask, one bit for its start and one for each character. A
step shifts the state by one bit, keeps the bits whose character fits, and keeps bits that stand
before a wildcard. Words of 64 bits hold many globs; a carry joins words, so a glob may be of any
length. A slice of URLs is simulated together, one character position after the other.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Stands between host and path; no byte of a URL has this code.
BAR = 256
_HOST, _ANY = "^", "*"


class Automaton:
    """Globs over codes 0..256. ``*`` fits any codes, ``^`` any codes but the bar between host and path, ``|`` the bar."""

    def __init__(self, globs: Sequence[str]):
        bits: list[tuple[int | None, str | None]] = []  # the code that leads here (None: a start), and the wildcard that follows
        starts, finals = [], []
        for glob in globs:
            starts.append(len(bits))
            bits.append((None, None))
            for byte in glob.encode():
                char = chr(byte)
                if char in (_HOST, _ANY):
                    bits[-1] = (bits[-1][0], _ANY if _ANY in (char, bits[-1][1]) else _HOST)
                else:
                    bits.append((BAR if char == "|" else byte, None))
            finals.append(len(bits) - 1)
        self.words = max(1, -(-len(bits) // 64))
        self.match = np.zeros((257, self.words), np.uint64)
        self.loop = np.zeros((257, self.words), np.uint64)
        self.begin = np.zeros(self.words, np.uint64)
        for bit, (code, wild) in enumerate(bits):
            word, mask = bit // 64, np.uint64(1 << (bit % 64))
            if code is not None:
                self.match[code, word] |= mask
            if wild:
                self.loop[:, word] |= mask
                if wild == _HOST:
                    self.loop[BAR, word] &= ~mask
        for bit in starts:
            self.begin[bit // 64] |= np.uint64(1 << (bit % 64))
        self.finals = np.array(finals, np.int64)

    def run(self, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Which glob fits which row: rows x globs. ``codes`` is rows x longest, padded."""
        state = np.repeat(self.begin[None, :], len(codes), axis=0)
        for place in range(codes.shape[1] if len(codes) else 0):
            live = np.flatnonzero(lengths > place)
            code, now = codes[live, place], state[live]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[live] = (moved & self.match[code]) | (now & self.loop[code])
        return (state[:, self.finals // 64] >> (self.finals % 64).astype(np.uint64)) & np.uint64(1) != 0


def host_glob(host: str, path: str) -> str:
    """The glob of a rule that fits a host, all its subdomains, and every path with the given start."""
    return f"^.{host}|{path}*"


def parts(url) -> tuple:
    """Host (A-Z lower-cased) and path of a URL column; both empty for NULL or without ``://``."""
    ok = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(ok, lower).otherwise(""), F.when(ok, path).otherwise("")


def _judge(batches: Iterator[pa.RecordBatch], machine: Automaton, limit: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts = [("." + x).encode() for x in batch.column("host").to_pylist()]
        paths = [x.encode() for x in batch.column("path").to_pylist()]
        order = np.argsort([len(a) + len(b) for a, b in zip(hosts, paths)], kind="stable")
        fits: list = [None] * batch.num_rows
        begin = 0
        while begin < len(order):
            end, widest = begin, 0
            while end < len(order):  # rows of like lengths together, so that padding stays small
                size = len(hosts[order[end]]) + len(paths[order[end]]) + 1
                if end > begin and (max(widest, size) * (end + 1 - begin) > limit):
                    break
                widest, end = max(widest, size), end + 1
            codes, lengths = np.zeros((end - begin, widest), np.int16), np.zeros(end - begin, np.int64)
            for k, row in enumerate(order[begin:end]):
                a, b = hosts[row], paths[row]
                codes[k, : len(a)] = np.frombuffer(a, np.uint8)
                codes[k, len(a)] = BAR
                codes[k, len(a) + 1 : len(a) + 1 + len(b)] = np.frombuffer(b, np.uint8)
                lengths[k] = len(a) + len(b) + 1
            found = machine.run(codes, lengths)
            for k, row in enumerate(order[begin:end]):
                fits[row] = np.flatnonzero(found[k]).tolist()
            begin = end
        names = batch.schema.names
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(fits, pa.list_(pa.int32()))], [*names, "fits"])


def match_rules(pages: DataFrame, key: str, globs: Sequence[str], limit: int = 4 << 20) -> DataFrame:
    """key, host, path, fits: the numbers of all globs that fit each URL of ``pages`` (key, url).

    A NULL url, or one without ``://``, has an empty host and path. One row per row of pages; other
    columns are not read. ``limit`` bounds the padded characters simulated at once (a longer URL runs alone).
    """
    machine = Automaton(globs)
    host, path = parts(F.col("url"))
    ready = pages.select(F.col(key).alias("page_key"), host.alias("host"), path.alias("path"))
    kind = ready.schema["page_key"].dataType.simpleString()
    return ready.mapInArrow(lambda it: _judge(it, machine, limit), f"page_key {kind}, host string, path string, fits array<int>").withColumnRenamed("page_key", key)


#: Rules of host and path with a fixed verdict; the longest that fits wins.
BASE_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))

#: Globs for URLs that no base rule fits: tracking, print and archive copies, and listing pages.
EXTRA_BLOCK = (
    "^.ads.^|*", "^.ad.^|*", "^.tracker.^|*", "^.cdn.^|*", "^|*/print/*", "^|*/amp/*", "^|*/tag/*", "^|*/login*", "^|*/cart*", "^|*.zip",
    "^|*.exe", "^|*.jpg", "^|*.png", "^|*/feed/", "^casino^|*", "^|*/search*", "^|*/wp-admin/*", "^|*/page/*/", "^.m.^|/en/9*", "^|/*/*.php",
)


def judge(pages: DataFrame, key: str = "page_id", rules: Sequence[tuple[str, str]] = BASE_RULES, extra: Sequence[str] = EXTRA_BLOCK) -> DataFrame:
    """key, host, path, rule, verdict of each URL; rule is NULL where an extra glob or the default (allow) decided."""
    globs = [host_glob(*_cut(rule)) for _, rule in rules] + list(extra)
    matched = match_rules(pages, key, globs)
    order = sorted(range(len(rules)), key=lambda k: -len(rules[k][1]))
    pick = F.coalesce(*(F.when(F.array_contains("fits", k), F.lit(k)) for k in order))
    matched = matched.withColumn("picked", pick)
    rule, verdict = F.lit(None).cast("string"), F.when(F.size("fits") > 0, "block").otherwise("allow")
    for k, (say, text) in enumerate(rules):
        rule = F.when(F.col("picked") == k, text).otherwise(rule)
        verdict = F.when(F.col("picked") == k, say).otherwise(verdict)
    return matched.select(key, "host", "path", rule.alias("rule"), verdict.alias("verdict"))


def _cut(rule: str) -> tuple[str, str]:
    host, _, path = rule.partition("/")
    return host, "/" + path
