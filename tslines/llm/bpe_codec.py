"""BPE encoding and decoding with forced boundaries.

Two neighbouring bytes that stand side by side inside no token of the vocabulary can never
be joined by a merge. Every such pair in a word is a certain cut: the fragments on both
sides are encoded on their own and their ids put one after the other. White space is a cut
as well, since the tokenizer drops it. Fragments recur far more often than words, so a
worker merges each of them once and copies ids for the rest with array operations.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tslines.llm.bpe_automaton import byte_letters
from tslines.llm.common import whole_text

#: Stretches without white space, and words, whose ids a worker remembers before it lets go of
#: those it has met once.
REMEMBERED = 200_000
# all white space as Unicode has it, which the tokenizer drops
STRETCHES = re.compile(r"[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
# Libraries know the classes of newer characters differently; those from here on are left
# to the tokenizer's own library.
UNSURE = re.compile("[\u0500-\U0010ffff]")
#: More than the letters that spell bytes.
LETTERS = 512


class Known:
    """Ids of texts met before. Texts are numbered as they come; `starts` and `ids` hold the ids of
    each number, `hits` how often it was asked for of late."""

    def __init__(self, limit: int = REMEMBERED):
        self.limit, self.number = limit, {}
        self.starts, self.ids, self.hits = np.zeros(1, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64)

    def add(self, texts: list[str], sizes: np.ndarray, ids: np.ndarray) -> None:
        self.number.update(zip(texts, range(len(self.number), len(self.number) + len(texts)), strict=True))
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes, dtype=np.int64)])
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])

    def missing(self, texts: Iterable[str]) -> list[str]:
        return list(dict.fromkeys(itertools.filterfalse(self.number.__contains__, texts)))

    def numbers(self, texts: Iterable[str]) -> np.ndarray:
        which = np.fromiter(map(self.number.__getitem__, texts), np.int64)
        found = np.bincount(which, minlength=len(self.number))
        found[: len(self.hits)] += self.hits
        self.hits = found
        return which

    def trim(self) -> None:
        """Past the limit, keep what was met more than once, or more often if that is still much."""
        if len(self.number) <= self.limit:
            return
        hits = np.concatenate([self.hits, np.zeros(len(self.number) - len(self.hits), np.int64)])
        least = 2
        while (hits >= least).sum() > self.limit // 2:
            least *= 2
        kept = np.flatnonzero(hits >= least)
        sizes = np.diff(self.starts)[kept]
        self.ids = _gather(self.starts, self.ids, kept)
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.number = {t: i for i, t in enumerate(itertools.compress(self.number, (hits >= least).tolist()))}
        self.hits = hits[kept] // 2

    def ids_of(self, text: str) -> list[int]:
        at = self.number[text]
        return self.ids[self.starts[at] : self.starts[at + 1]].tolist()


class Encoder:
    """A word-level BPE file made ready for encoding in one worker."""

    def __init__(self, path: str):
        # a task has one core; the library would else start threads, each with memory of its own
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None
        model = spec["model"]
        # the merges alone, once for the end of a word and once for what stands before it
        bare = spec | {"normalizer": None, "pre_tokenizer": None, "post_processor": None, "added_tokens": []}
        self.last = Tokenizer.from_str(json.dumps(bare))
        self.inner = Tokenizer.from_str(json.dumps(bare | {"model": model | {"end_of_word_suffix": None}}))
        # how texts are prepared, without a vocabulary
        empty = {"type": "BPE", "vocab": {}, "merges": []}
        before = Tokenizer.from_str(json.dumps(bare | {"normalizer": spec["normalizer"], "pre_tokenizer": spec["pre_tokenizer"], "model": empty}))
        self.normalizer, self.pre_tokenizer = before.normalizer, before.pre_tokenizer
        words = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(words + "| ")
        self.letters = {b: c for c, b in byte_letters().items() if b != ord("\n")}
        self.joined = self._side_by_side(model["vocab"], model["end_of_word_suffix"] or "")
        self.stretches, self.known_words = Known(), Known()

    @staticmethod
    def _side_by_side(vocab: dict[str, int], suffix: str) -> np.ndarray:
        """Whether some token holds two letters side by side; any other pair is a certain cut."""
        table = np.zeros((LETTERS, LETTERS), bool)
        for token in vocab:
            codes = list(map(ord, token.removesuffix(suffix) if suffix else token))
            table[codes[:-1], codes[1:]] = True
        return table

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of distinct words. Words are parted at their certain cuts, and equal
        fragments are merged once."""
        joined = "".join(words)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(w) for w in words])
        cut = ~self.joined[codes[:-1], codes[1:]]
        cut[ends[:-1] - 1] = False
        at = np.flatnonzero(cut) + 1
        owner = np.searchsorted(ends, at, side="right")
        whole = np.ones(len(words), bool)
        whole[owner] = False
        parted = np.flatnonzero(~whole)
        # the fragments of the words that have cuts, in their order
        begin = np.sort(np.concatenate([np.where(parted > 0, ends[parted - 1], 0), at]))
        end = np.sort(np.concatenate([at, ends[parted]]))
        pieces = [joined[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
        of = np.searchsorted(ends, begin, side="right")
        closes = end == ends[of]
        lasts = {w: i for i, w in enumerate(dict.fromkeys([*itertools.compress(words, whole.tolist()), *itertools.compress(pieces, closes.tolist())]))}
        inners = {w: len(lasts) + i for i, w in enumerate(dict.fromkeys(itertools.compress(pieces, (~closes).tolist())))}
        lists = [e.ids for tool, names in ((self.last, lasts), (self.inner, inners)) for e in tool.encode_batch_fast(list(names), add_special_tokens=False)]
        starts = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
        ids = np.fromiter(itertools.chain.from_iterable(lists), np.int32, starts[-1])
        # every word's fragments by number, whole words being one
        number = np.zeros(len(pieces), np.int64)
        number[closes] = [lasts[w] for w in itertools.compress(pieces, closes.tolist())]
        number[~closes] = [inners[w] for w in itertools.compress(pieces, (~closes).tolist())]
        single = np.flatnonzero(whole)
        every = np.concatenate([[lasts[words[i]] for i in single.tolist()], number]).astype(np.int64)
        owners = np.concatenate([single, of])
        order = np.argsort(owners, kind="stable")
        every, owners = every[order], owners[order]
        sizes = np.bincount(owners, np.diff(starts)[every], len(words)).astype(np.int64)
        return sizes, _gather(starts, ids, every)

    def _learn(self, stretches: list[str]) -> None:
        """Encode stretches not met yet, all of them together."""
        special = [s for s in stretches if "<|" in s and self.special and self.special.search(s)]
        if special:
            # special strings stand for themselves, what lies between them is learned first
            parts = [[p for p in self.special.split(s) if p] for s in special]
            plain = [s for s in stretches if s not in set(special)]
            between = (p for found in parts for p in found if p not in self.specials)
            self._learn(self.stretches.missing([*plain, *between]))
            ids = [[i for p in found for i in ([self.specials[p]] if p in self.specials else self.stretches.ids_of(p))] for found in parts]
            self.stretches.add(special, np.array([len(i) for i in ids]), np.array([i for x in ids for i in x]))
            return
        if not stretches:
            return
        # nothing reaches across a blank, so all are prepared as one text
        text = self.normalizer.normalize_str(" ".join(stretches))
        pieces = self._words(text)
        blank = np.fromiter((p == " " for p in pieces), bool, len(pieces))
        owner = np.cumsum(blank)[~blank]
        words = "\n".join(p for p in pieces if p != " ").encode().decode("latin-1").translate(self.letters).split("\n")
        words = words if len(owner) else []
        new = self.known_words.missing(words)
        if new:
            self.known_words.add(new, *self._encode_words(new))
        which = self.known_words.numbers(words)
        sizes = np.diff(self.known_words.starts)[which]
        taken = _gather(self.known_words.starts, self.known_words.ids, which)
        self.stretches.add(stretches, np.bincount(owner, sizes, len(stretches)).astype(np.int64), taken)

    def _words(self, text: str) -> list[str]:
        """The words of a prepared text and the blanks between its stretches."""
        if not UNSURE.search(text):
            return self.words.findall(text)
        out: list[str] = []
        for stretch in text.split(" "):
            if UNSURE.search(stretch):
                out += [stretch[a:b] for _, (a, b) in self.pre_tokenizer.pre_tokenize_str(stretch)]
            else:
                out += self.words.findall(stretch)
            out.append(" ")
        return out[:-1]

    def encode(self, texts: list[str]) -> pa.ListArray:
        found = [STRETCHES.findall(t) for t in texts]
        self.stretches.trim()
        self.known_words.trim()
        self._learn(self.stretches.missing(itertools.chain.from_iterable(found)))
        which = self.stretches.numbers(itertools.chain.from_iterable(found))
        starts = self.stretches.starts
        ends = np.concatenate([[0], np.cumsum(starts[which + 1] - starts[which])])
        rows = ends[np.concatenate([[0], np.cumsum([len(f) for f in found])])].astype(np.int64)
        return pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.array(_gather(starts, self.stretches.ids, which), pa.int32()))


def _gather(starts: np.ndarray, ids: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The ids of numbers, one number after the other."""
    sizes = starts[which + 1] - starts[which]
    ends = np.cumsum(sizes)
    return ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[which] - (ends - sizes), sizes)]


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One encoder for all tasks of a worker."""
    return Encoder(path)


@functools.lru_cache(maxsize=1)
def token_names(path: str) -> pa.Array:
    """Every id's token as the vocabulary spells it; null where an id has none."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    names = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
    return pa.array([names.get(i) for i in range(max(names) + 1)], pa.string())


def spell(ids: pa.ListArray, names: pa.Array) -> pa.Array:
    """The text of each list of ids. The file names no decoder, so tokens stand as in the
    vocabulary with blanks between."""
    tokens = names.take(ids.flatten())
    sizes = pc.list_value_length(ids).to_numpy()
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), tokens), " ")


def _kept(df: DataFrame, keep: list[str]) -> list[Column]:
    return [F.col(c).alias(f"k{n}") for n, c in enumerate(keep)]


def _fields(df: DataFrame, keep: list[str]) -> str:
    return "".join(f"k{n} {df.schema[c].dataType.simpleString()}, " for n, c in enumerate(keep))


def encode(df: DataFrame, path: str, keep: list[str], text: str = "text", decoded: bool = False) -> DataFrame:
    """The columns `keep` and `ids`, the token ids of each whole text, special strings inside
    texts as the library takes them; with `decoded` also the text that the ids decode to,
    made in the same pass.

    No shuffle. A null or empty text, or one of white space, has no ids. Rows are
    independent, so repeated rows and any ids are as they come; columns outside `keep` are
    not read. What a worker remembers is bounded.
    """

    def run(batches: Iterator) -> Iterator:
        tool = encoder(path)
        for batch in batches:
            if batch.num_rows:
                ids = tool.encode(batch.column(len(keep)).to_pylist())
                made = [ids, spell(ids, token_names(path))] if decoded else [ids]
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *made], [*batch.schema.names[: len(keep)], *outputs])

    outputs = ["ids", "decoded"] if decoded else ["ids"]
    rows = df.select(*_kept(df, keep), whole_text(text).alias("text"))
    schema = _fields(df, keep) + ", ".join(["ids array<int>", "decoded string"][: len(outputs)])
    return rows.mapInArrow(run, schema).toDF(*keep, *outputs)


def decode(df: DataFrame, path: str, keep: list[str], ids: str = "ids") -> DataFrame:
    """The columns `keep` and `decoded`, the text of each row's ids. Null or no ids: empty."""

    def run(batches: Iterator) -> Iterator:
        names = token_names(path)
        for batch in batches:
            if batch.num_rows:
                texts = spell(batch.column(len(keep)), names)
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], texts], [*batch.schema.names[: len(keep)], "decoded"])

    rows = df.select(*_kept(df, keep), F.coalesce(F.col(ids), F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(run, f"{_fields(df, keep)}decoded string").toDF(*keep, "decoded")
