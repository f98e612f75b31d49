"""URL rules as wildcard patterns, all simulated at once by a bit-parallel automaton.

Every pattern is laid out as a run of bits over as many 64-bit words as needed (Shift-And).
Reading one character shifts all bits by one and keeps those whose pattern position takes
that character; positions with a star also keep themselves. A batch of URLs is a matrix of
words, so one step serves every pattern and every URL of the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tslines.llm.common import ascii_lower

#: Cells of the character matrix worked on at once.
CELLS = 1 << 21
#: What a url gets that no rule fits.
DEFAULT = "allow"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


class Patterns:
    """Globs compiled to masks. `*` takes any run without a slash, `**` any run, `?` one
    character other than a slash; all else stands for itself. A glob takes the whole text."""

    def __init__(self, globs: list[str]):
        positions: list[tuple[str, str]] = []  # character (or ? for any), star that follows
        self.first, self.last = [], []
        for glob in globs:
            # an empty place before the first character carries a star that leads
            place, rest = [["", ""]], glob
            while rest:
                star = "**" if rest.startswith("**") else "*" if rest[0] == "*" else ""
                if star:
                    place[-1][1] = max(star, place[-1][1])
                    rest = rest[len(star) :]
                else:
                    place.append([rest[0], ""])
                    rest = rest[1:]
            self.first.append(len(positions))
            positions += [tuple(p) for p in place]
            self.last.append(len(positions) - 1)
        self.words = -(-max(len(positions), 1) // 64)
        self.alphabet = np.array(sorted({ord(c) for c, _ in positions if c and c != "?"} | {ord("/")}), np.uint32)
        # one row of masks for each character of the patterns, the last for all others
        self.takes = np.zeros((len(self.alphabet) + 1, self.words), np.uint64)
        self.loops = np.zeros_like(self.takes)
        self.start = np.zeros(self.words, np.uint64)
        slash = int(np.searchsorted(self.alphabet, ord("/")))
        for at, (char, star) in enumerate(positions):
            word, bit = at // 64, np.uint64(1 << (at % 64))
            for row in range(len(self.takes)):
                same = char and row < len(self.alphabet) and chr(self.alphabet[row]) == char
                if same and char != "?" or char == "?" and row != slash:
                    self.takes[row, word] |= bit
                if star == "**" or star == "*" and row != slash:
                    self.loops[row, word] |= bit
        for at in self.first:
            self.start[at // 64] |= np.uint64(1 << (at % 64))

    def match(self, texts: list[str]) -> np.ndarray:
        """A row of flags per text, one for each glob. Texts of like length go together, so a
        long one does not widen the others."""
        out = np.zeros((len(texts), len(self.last)), bool)
        order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
        while order:
            n = 1
            while n < len(order) and (n + 1) * len(texts[order[-n - 1]]) <= CELLS and len(texts[order[-1]]) * (n + 1) <= CELLS:
                n += 1
            some, order = order[-n:], order[:-n]
            out[some] = self._match([texts[i] for i in some])
        return out

    def _match(self, texts: list[str]) -> np.ndarray:
        """Texts by growing length."""
        sizes = np.array([len(t) for t in texts])
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        row = np.searchsorted(self.alphabet, codes)
        row = np.where((row < len(self.alphabet)) & (self.alphabet[np.minimum(row, len(self.alphabet) - 1)] == codes), row, len(self.alphabet))
        starts = np.cumsum(sizes) - sizes
        state = np.tile(self.start, (len(texts), 1))
        for step in range(int(sizes[-1]) if len(sizes) else 0):
            on = int(np.searchsorted(sizes, step, side="right"))  # texts that still have a character
            at = row[starts[on:] + step]
            now = state[on:]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[on:] = moved & self.takes[at] | now & self.loops[at]
        ends = np.array(self.last, np.int64)
        return (state[:, ends // 64] >> (ends % 64).astype(np.uint64) & np.uint64(1)).astype(bool)


def host_of(url: Column) -> Column:
    """From the first `://` to the next `/`, `?`, `#` or the end, A-Z in lower case."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def globs_of(rule: Rule) -> list[str]:
    """A rule's own host and any of its subdomains, then every path that begins like it."""
    return [f"{rule.host}{rule.path}**", f"*.{rule.host}{rule.path}**"]


def judge_urls(df: DataFrame, rules: list[Rule], id_col: str = "page_id", url: str = "url", default: str = DEFAULT) -> DataFrame:
    """The id, `host`, `path`, `rule` and `verdict` of every row.

    Of all rules that fit, the one with the longest name wins; of equally long ones the
    longer host, then block, then the name. No rule: null and `default`. A null url, or one
    without `://`, has an empty host and path, which no rule fits. Rows are independent;
    other columns are not read. No shuffle; rules are few and go with the task.
    """
    ranked = sorted(set(rules), key=lambda r: (-len(r.name), -len(r.host), r.verdict != "block", r.name))
    patterns = Patterns([g for r in ranked for g in globs_of(r)])
    names = pa.array([r.name for r in ranked] + [None], pa.string())
    verdicts = pa.array([r.verdict for r in ranked] + [default], pa.string())

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            if not batch.num_rows:
                continue
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            fits = patterns.match([h + p for h, p in zip(hosts, paths, strict=True)])
            either = fits.reshape(len(hosts), -1, 2).any(axis=2) if ranked else np.zeros((len(hosts), 0), bool)
            best = np.where(either.any(axis=1), either.argmax(axis=1), len(ranked)) if ranked else np.zeros(len(hosts), int)
            best = pa.array(best)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, names.take(best), verdicts.take(best)], ["id", "host", "path", "rule", "verdict"]
            )

    rows = df.select(F.col(id_col).alias("id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, host string, path string, rule string, verdict string"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
