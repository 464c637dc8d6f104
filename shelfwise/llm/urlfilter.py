"""URL rules by a bit-parallel wildcard automaton.

Rules are globs over a canonical url, ``"." + host + path``: ``*`` stands for
any bytes but ``/``, ``**`` for any bytes, ``?`` for one byte but ``/``, and a
backslash takes the next character as it is. All globs are packed into one
multiword bit mask (Shift-And with self loops at the stars), and every rule is
simulated over each url at the same time, for all urls of a batch at once.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
in lower case; path: from there up to ``?``, ``#`` or the end. A null url or
one without ``://`` has both empty and fits no rule. Where several rules fit,
the longest wins, then block before allow, then the name; where none fits, the
verdict is the default and the rule null. Rows are independent: repeated rows
get equal results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

ALLOW, BLOCK = "allow", "block"
URLS_AT_ONCE = 8192


@dataclass(frozen=True)
class Rule:
    name: str
    glob: str
    verdict: str
    length: int


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits the host and all its subdomains where the url's path starts with ``path``."""
    literal = re.sub(r"([*?\\])", r"\\\1", host + path)
    return Rule(host + path, f"*.{literal}**", verdict, len(host + path))


class Automaton:
    """All rules as bits: a start bit for each rule, then one bit for each byte to be read."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = sorted(rules, key=lambda r: (-r.length, r.verdict != BLOCK, r.name))
        steps: list[tuple[int, list]] = []     # by bit: what may be read to get there, what it loops on
        start, final = [], []
        any_byte, within = np.ones(256, bool), np.arange(256) != 0x2F
        for rule in self.rules:
            start.append(len(steps))
            steps.append([np.zeros(256, bool), np.zeros(256, bool)])
            for kind, byte in self.tokens(rule.glob):
                if kind == "star":
                    steps[-1][1] = steps[-1][1] | (any_byte if byte else within)
                else:
                    steps.append([within if byte is None else np.arange(256) == byte, np.zeros(256, bool)])
            final.append(len(steps) - 1)
        self.words = max(1, -(-len(steps) // 64))
        self.start = self.pack(np.isin(np.arange(len(steps)), start)[None])[0]
        reads = np.array([s[0] for s in steps], bool).reshape(-1, 256)
        loops = np.array([s[1] for s in steps], bool).reshape(-1, 256)
        self.reads, self.loops = self.pack(reads.T), self.pack(loops.T)
        self.final = np.array(final, np.int64)

    @staticmethod
    def tokens(glob: str) -> Iterator[tuple[str, int | None]]:
        for m in re.finditer(r"(\*+)|(\?)|\\?(.)", glob, re.S):
            if m[1]:
                yield "star", int(len(m[1]) > 1)
            elif m[2]:
                yield "byte", None
            else:
                yield from (("byte", b) for b in m[3].encode())

    def pack(self, bits: np.ndarray) -> np.ndarray:
        """Rows of booleans as rows of little-endian 64-bit words."""
        out = np.zeros((len(bits), 64 * self.words), np.uint8)
        out[:, :bits.shape[1]] = bits
        return np.packbits(out, axis=1, bitorder="little").view(np.uint64)

    def match(self, urls: list[bytes]) -> np.ndarray:
        """The number of the first rule that fits each url, -1 if none does."""
        best = np.full(len(urls), -1, np.int64)
        if not self.rules:
            return best
        size = np.fromiter(map(len, urls), np.int64, len(urls))
        by = np.argsort(-size, kind="stable")
        buf = np.frombuffer(b"".join(urls) + b"\0", np.uint8)
        begin = (np.cumsum(size) - size)[by]
        state = np.tile(self.start, (len(urls), 1))
        for step in range(int(size.max(initial=0))):
            n = int(np.searchsorted(-size[by], -step, "left"))   # the longer urls come first
            byte, now = buf[begin[:n] + step], state[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:n] = (moved & self.reads[byte]) | (now & self.loops[byte])
        fits = (state[:, self.final >> 6] >> (self.final & 63).astype(np.uint64)) & np.uint64(1)
        best[by] = np.where(fits.any(axis=1), fits.argmax(axis=1), -1)
        return best


def host_and_path(url: bytes | None) -> tuple[bytes, bytes]:
    m = re.match(rb".*?://([^/?#]*)([^?#]*)", url or b"", re.S)
    return (m[1].lower(), m[2]) if m else (b"", b"")


def judge_column(url: str, rules: Sequence[Rule], default: str = ALLOW):
    """struct(host, path, rule, verdict) of a url column."""
    rules = list(rules)

    @pandas_udf("host string, path string, rule string, verdict string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = Automaton(rules)
        for batch in batches:
            parts = [host_and_path(u) for u in batch]
            best = np.concatenate([np.zeros(0, np.int64), *[
                automaton.match([b"." + h + p if h or p else b"" for h, p in parts[i:i + URLS_AT_ONCE]])
                for i in range(0, len(parts), URLS_AT_ONCE)]])
            yield pd.DataFrame({
                "host": [h.decode("utf-8", "replace") for h, _ in parts], "path": [p.decode("utf-8", "replace") for _, p in parts],
                "rule": [automaton.rules[i].name if i >= 0 else None for i in best],
                "verdict": [automaton.rules[i].verdict if i >= 0 else default for i in best]})

    return run(F.col(url).cast("binary"))


def judge(pages: DataFrame, rules: Sequence[Rule], default: str = ALLOW, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row: page_id, host, path, rule, verdict."""
    return pages.select(F.col(id_col).alias("page_id"), judge_column(url_col, rules, default).alias("j")).select("page_id", "j.*")
