"""Token counts of a BPE vocabulary by rank-synchronous merging of arrays.

A batch of pre-tokens is held as one flat array of symbols with the sequence
each belongs to.  In every round each sequence finds its lowest-ranked pair and
merges all its occurrences at once; sequences without a pair are done, and what
is left of their symbols is their count.

The library that reads the vocabulary normalises and splits the texts; the
merging, which is the work, is done here.  A piece between ASCII white space is
counted once per task as long as it stays in a bounded cache.

Null and empty texts have no tokens.  Every row gives a row, repeats included.
A very long text is counted whole, in slices of its pre-tokens.  Columns of the
input stay in ``doc``, so no name can clash.
"""

from __future__ import annotations

import json
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from tidemark.llm.tables import map_texts

CACHED_PIECES = 400_000
CACHED_LENGTH = 64
_NONE = np.iinfo(np.int32).max


class RankMerger:
    """The merges of a vocabulary file, and the pieces of text they apply to."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.library = Tokenizer.from_str(json.dumps(spec))
        self.suffix = model.get("end_of_word_suffix") or ""
        self.vocab = model["vocab"]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.special_parts = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.width = max(self.vocab.values()) + 1
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([self.vocab[a] * self.width + self.vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([self.vocab[a + b] for a, b in pairs], np.int64)

    def pieces(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text, and how many special strings stand in it."""
        parts, specials = [text], 0
        if self.special_parts is not None and "<" in text:
            parts = self.special_parts.split(text)
            specials = len(parts) - 1
        out = []
        for part in parts:
            if part:
                clean = self.library.normalizer.normalize_str(part)
                out += [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(clean)]
        return out, specials

    def count(self, pre_tokens: list[str]) -> np.ndarray:
        """The number of tokens of each pre-token."""
        vocab, suffix, symbols, lengths = self.vocab, self.suffix, [], []
        for token in pre_tokens:
            ids = [vocab.get(c) for c in token[:-1]]
            ids.append(vocab.get(token[-1] + suffix))
            ids = [i for i in ids if i is not None]
            symbols += ids
            lengths.append(len(ids))
        counts = np.array(lengths, np.int64)
        live = np.flatnonzero(counts > 1)
        sequence = np.repeat(np.arange(len(counts)), counts)
        symbols = np.array(symbols, np.int64)
        if len(live) < len(counts):
            wanted = counts[sequence] > 1
            symbols, sequence = symbols[wanted], sequence[wanted]
        while len(symbols):
            rank = self._pair_ranks(symbols, sequence)
            starts = np.flatnonzero(np.concatenate(([True], sequence[1:] != sequence[:-1])))
            sizes = np.diff(np.concatenate((starts, [len(symbols)])))
            lowest = np.minimum.reduceat(rank, starts)
            done = lowest == _NONE
            counts[sequence[starts[done]]] = sizes[done]
            low = np.repeat(lowest, sizes)
            here = (rank == low) & (low != _NONE)
            # Of overlapping occurrences (a pair of equal symbols in a row),
            # every second one from the left.
            place = np.arange(len(here))
            begin = np.maximum.accumulate(np.where(here & ~np.concatenate(([False], here[:-1])), place, -1))
            here &= (place - begin) % 2 == 0
            symbols = np.where(here, self.merged[np.minimum(rank, len(self.merged) - 1)], symbols)
            stays = ~np.concatenate(([False], here[:-1])) & ~np.repeat(done, sizes)
            symbols, sequence = symbols[stays], sequence[stays]
        return counts

    def _pair_ranks(self, symbols: np.ndarray, sequence: np.ndarray) -> np.ndarray:
        rank = np.full(len(symbols), _NONE, np.int32)
        if len(symbols) > 1:
            key = symbols[:-1] * self.width + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            good = (self.keys[at] == key) & (sequence[:-1] == sequence[1:])
            rank[:-1][good] = self.ranks[at[good]]
        return rank


class PieceCounter:
    """Counts of whole texts, with the counts of short pieces kept for a while."""

    def __init__(self, merger: RankMerger):
        self.merger = merger
        self.known: dict[bytes, int] = {}

    def __call__(self, texts: list) -> list[int]:
        # bytes.split() parts at ASCII white space only, where the vocabulary's
        # own splitting parts as well.
        split = [t.split() if t else [] for t in texts]
        fresh = {}
        for pieces in split:
            for p in pieces:
                if p not in self.known:
                    fresh[p] = 0
        if fresh:
            self._learn(fresh)
        known = self.known
        out = [sum(map(known.__getitem__, pieces)) for pieces in split]
        if len(known) > CACHED_PIECES:
            self.known = {}
        else:
            for p in fresh:
                if len(p) > CACHED_LENGTH:
                    del known[p]
        return out

    def _learn(self, fresh: dict) -> None:
        owners, tokens = [], []
        for i, p in enumerate(fresh):
            parts, specials = self.merger.pieces(p.decode("utf-8", "replace"))
            self.known[p] = specials
            owners += [i] * len(parts)
            tokens += parts
        counts = self.merger.count(tokens) if tokens else np.zeros(0, np.int64)
        totals = np.bincount(np.array(owners, np.int64), weights=counts, minlength=len(fresh))
        for p, n in zip(fresh, totals, strict=True):
            self.known[p] += int(n)


def token_counts(
    docs: DataFrame, vocabulary: str, *, doc_id: str = "doc_id", text: str = "text", limit: int = 2048
) -> DataFrame:
    """Bytes and tokens of every text, and whether it has more tokens than ``limit``.

    ``vocabulary`` is a ``tokenizers`` BPE file that every executor can open at
    that path.
    """

    def make():
        counter = PieceCounter(RankMerger(vocabulary))
        return lambda texts: ([len(t) if t else 0 for t in texts], counter(texts))

    fields = [StructField("n_bytes", LongType()), StructField("n_tokens", LongType())]
    return map_texts(docs, text, fields, make, [doc_id]).select(
        F.col(f"doc.`{doc_id}`").alias("doc_id"),
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
