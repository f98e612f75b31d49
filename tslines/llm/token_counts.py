"""Token counts by a tokenizer compiled to finite-state form.

A text is cut into chunks. Each chunk is turned into its state map: what it does to the
tokenizer's state, whatever that state is when the chunk begins. In a byte-level tokenizer
a token never reaches across a place where white space follows something else, so a map is
the text up to the first such place, the tokens between first and last place, and the text
from the last place on. Maps compose associatively, and a balanced scan joins them. Pieces
between places run through the counting transducer of `bpe_automaton`.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tslines.llm.bpe_automaton import Transducer, Vocabulary, byte_letters
from tslines.llm.common import Memo, text_batches, whole_text

CHUNK_CHARS = 1 << 16
#: Pieces whose counts a worker remembers.
REMEMBERED = 400_000

# From one sure place to the next. A place lies before a blank or line feed that follows
# something not white; after other white space the piece goes on.
PIECES = re.compile(r"[ \n]*[^ \n]+(?:(?<=\s)[ \n]+[^ \n]*)*|[ \n]+")

# How byte-level tokenizers part a text before merging.
# Libraries know the classes of newer characters differently; texts with one from here on
# are parted by the tokenizer's own library.
UNSURE = re.compile("[\u0500-\U0010ffff]")
PRE_TOKENS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def pre_tokenizer(path: str):
    """The part of a tokenizer file that parts texts before merging."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    empty = {"type": "BPE", "vocab": {}, "merges": []}
    return Tokenizer.from_str(json.dumps(spec | {"model": empty, "added_tokens": [], "post_processor": None})).pre_tokenizer


class StateMap(NamedTuple):
    """What a chunk does to any state. Without a sure place, `tail` is None and `head` all."""

    head: str
    count: int
    tail: str | None


class Counter:
    """The compiled tokenizer of one worker."""

    def __init__(self, path: str):
        vocabulary = Vocabulary(path)
        self.transducer = Transducer(vocabulary)
        self.specials = re.compile("|".join(map(re.escape, vocabulary.specials))) if vocabulary.specials else None
        self.pre_tokenizer = pre_tokenizer(path)
        self.bytes_of = {ord(c): b for c, b in byte_letters().items()}
        self.known = Memo(self._piece, REMEMBERED)
        self.known_pre = Memo(lambda p: self.transducer.count(p.encode()), REMEMBERED)

    def _plain(self, text: str) -> int:
        if UNSURE.search(text):
            parts = (w for w, _ in self.pre_tokenizer.pre_tokenize_str(text))
            return sum(self.transducer.count(w.translate(self.bytes_of).encode("latin-1")) for w in parts)
        return sum(map(self.known_pre.__getitem__, PRE_TOKENS.findall(text)))

    def _piece(self, piece: str) -> int:
        """Tokens between two sure places; special strings count one each and part the rest."""
        if self.specials is None or "<|" not in piece:
            return self._plain(piece)
        between = self.specials.split(piece)
        return sum(map(self._plain, between)) + len(between) - 1

    def tokens(self, text: str) -> int:
        return sum(map(self.known.__getitem__, PIECES.findall(text)))

    def state_map(self, chunk: str) -> StateMap:
        pieces = PIECES.findall(chunk)
        if len(pieces) < 2:
            return StateMap(chunk, 0, None)
        return StateMap(pieces[0], sum(map(self.known.__getitem__, pieces[1:-1])), pieces[-1])

    def compose(self, a: StateMap, b: StateMap) -> StateMap:
        if a.tail is None:
            return StateMap(a.head + b.head, b.count, b.tail)
        if b.tail is None:
            return StateMap(a.head, a.count, a.tail + b.head)
        return StateMap(a.head, a.count + self.tokens(a.tail + b.head) + b.count, b.tail)

    def scan(self, maps: list[StateMap]) -> StateMap:
        """All maps as one, joined pair by pair in a balanced tree."""
        while len(maps) > 1:
            pairs = [self.compose(a, b) for a, b in zip(maps[::2], maps[1::2], strict=False)]
            maps = pairs + maps[len(maps) & ~1 :]
        return maps[0] if maps else StateMap("", 0, None)

    def total(self, whole: StateMap) -> int:
        """The tokens of a map whose chunk begins and ends its text."""
        return self.tokens(whole.head) + whole.count + (self.tokens(whole.tail) if whole.tail else 0)

    def chunked(self, text: str, size: int) -> StateMap:
        return self.scan([self.state_map(text[i : i + size]) for i in range(0, len(text), size)])


@functools.lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One compiled tokenizer for all tasks of a worker."""
    return Counter(path)


def count_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """The id, `n_bytes` and `n_tokens` of every row, as the tokenizer file gives them.

    No shuffle. A null or empty text has 0 of both; ids may be null or repeated, each row
    counts for itself; other columns are not read. A text of any length is mapped chunk by
    chunk, so a task holds one batch of texts and the compiled states, which are bounded.
    """

    def run(batches: Iterator) -> Iterator:
        tool = counter(path)
        for batch, texts in text_batches(batches):
            counts = [tool.total(tool.chunked(t, chunk_chars)) if len(t) > chunk_chars else tool.tokens(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.binary_length(batch.column("text")).cast(pa.int64()), pa.array(counts, pa.int64())],
                ["id", "n_bytes", "n_tokens"],
            )

    rows = df.select(F.col(id_col).alias("id"), whole_text(text).alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def count_parts(df: DataFrame, path: str, key: str, order: str, text: str = "text") -> DataFrame:
    """Like `count_tokens` for texts whose parts are rows: `key` names the text, `order`
    sorts its parts (ties by their content). Every part becomes its state map where it lies;
    only maps are shuffled, and composed in order. Parts under a null key are one text.
    """

    def to_maps(batches: Iterator) -> Iterator:
        tool = counter(path)
        for batch, texts in text_batches(batches):
            maps = [tool.state_map(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pc.binary_length(batch.column("text")).cast(pa.int64()),
                    pa.array([m.head for m in maps], pa.string()),
                    pa.array([m.count for m in maps], pa.int64()),
                    pa.array([m.tail for m in maps], pa.string()),
                ],
                ["key", "pos", "n_bytes", "head", "cnt", "tail"],
            )

    def to_counts(batches: Iterator) -> Iterator:
        tool = counter(path)
        for batch in batches:
            groups = batch.column("maps").to_pylist()
            counts = [tool.total(tool.scan([StateMap(m["head"], m["cnt"], m["tail"]) for m in g])) for g in groups]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("n_bytes"), pa.array(counts, pa.int64())], ["key", "n_bytes", "n_tokens"]
            )

    parts = df.select(F.col(key).alias("key"), F.col(order).alias("pos"), whole_text(text).alias("text"))
    key_type, pos_type = (parts.schema[c].dataType.simpleString() for c in ("key", "pos"))
    maps = parts.mapInArrow(to_maps, f"key {key_type}, pos {pos_type}, n_bytes long, head string, cnt long, tail string")
    grouped = maps.groupBy("key").agg(
        F.sum("n_bytes").alias("n_bytes"),
        F.sort_array(F.collect_list(F.struct("pos", "head", "cnt", "tail"))).alias("maps"),
    )
    return grouped.mapInArrow(to_counts, f"key {key_type}, n_bytes long, n_tokens long").withColumnRenamed("key", key)
