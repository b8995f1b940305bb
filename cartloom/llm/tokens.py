"""Exact token counts at every prefix of a text, by dynamic programming over its pieces."""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.llm.common import query, table

#: Segments up to this many code points ask the library for all their prefixes.
SHORT = 32
#: Pieces and piece beginnings remembered by one Python worker, code points handled at a time.
REMEMBERED, BEGUN, SLICE_CHARS, ASKED = 400_000, 1_500_000, 1_000_000, 4096
#: Segments of these characters fall into pre-tokens by character class alone: no white
#: space, apostrophe, special token or composition is involved, and case has one form.
SIMPLE = "!-&(-;=-~À-ÖØ-öø-ÿ"
#: The pieces of a text that are counted apart: long and other segments whole, the rest by class.
PIECE = re.compile(
    rf"(?<![^ \t-\r])(?:[^ \t-\r]{{{SHORT + 1},}}|[{SIMPLE}]*+[^ \t-\r{SIMPLE}][^ \t-\r]*)"
    r"|[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]|[!-&(-/:;=-@\[-`{-~]+"
)
WORD = re.compile(f"[{SIMPLE}]+")
LIMIT = 2048


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _pack(counts: list[int]) -> bytes:
    return struct.pack(f"<{len(counts)}I", *counts)


class EndedBpe:
    """Prefix recurrence for one pre-token of a byte-pair vocabulary with word ends.

    A prefix has one last token: the only one that no merge across its left border
    would break. Counts follow from the count at that border.
    """

    def __init__(self, merges: list, end: str):
        self.end = end
        self.rank = {tuple(m): i for i, m in enumerate(merges)}
        self.split = {a + b: (a, b) for a, b in merges}
        self.made = {a + b: i for i, (a, b) in enumerate(merges)}
        self.longest = max(map(len, self.split), default=1)
        self.known: dict[str, bool] = {}

    def whole(self, token: str, symbols: list[str]) -> bool:
        """Whether the merges turn the symbols of a token back into it."""
        if token not in self.known:
            parts = list(symbols)
            while len(parts) > 1:
                ranks = [self.rank.get(p, len(self.rank)) for p in zip(parts, parts[1:])]
                low = min(ranks)
                if low == len(self.rank):
                    break
                at = ranks.index(low)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self.known[token] = parts == [token]
        return self.known[token]

    def stays(self, left: str, right: str) -> bool:
        """Whether two whole tokens next to each other are never merged across their border."""
        before = len(self.rank)
        while True:
            rank = self.rank.get((left, right))
            if rank is not None and rank < before:
                return False
            a, b = self.made.get(left, -1), self.made.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:
                before, left = a, self.split[left][1]
            else:
                before, right = b + 1, self.split[right][0]

    def counts(self, symbols: str) -> list[int]:
        """Tokens of ``symbols[:i]`` as a pre-token of its own, for i from 1."""
        last, plain, ended = [""], [0], []
        for i in range(1, len(symbols) + 1):
            for size in range(min(i, self.longest), 0, -1):
                token, at = symbols[i - size : i], i - size
                if (size == 1 or token in self.made) and (self.stays(last[at], token) if at else self.whole(token, list(token))):
                    last.append(token)
                    plain.append(plain[at] + 1)
                    break
            for size in range(min(i, self.longest), 0, -1):
                body, at = symbols[i - size : i], i - size
                token = body + self.end
                if (size == 1 or token in self.made) and (self.stays(last[at], token) if at else self.whole(token, [*body[:-1], body[-1] + self.end])):
                    ended.append(plain[at] + 1)
                    break
        return ended


class PrefixCounter:
    """Token counts of all prefixes of the pieces of a text.

    The tokenizer must drop white space, so that a text's tokens are its pieces'
    tokens one after the other; this is tried when it is loaded.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        if self.ask(["a b\n c"]) != [sum(self.ask(["a", "b", "c"]))]:
            raise ValueError("this tokenizer does not drop white space")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.bpe = EndedBpe(merges, spec["model"].get("end_of_word_suffix") or "")
        added = sorted((a["content"] for a in spec["added_tokens"]), key=len, reverse=True)
        if any(WORD.fullmatch(a) for a in added):
            raise ValueError("this tokenizer has a special token that may lie inside a word")
        self.symbols = {c: self.lib.pre_tokenizer.pre_tokenize_str(chr(c))[0][0] for c in range(33, 256) if WORD.fullmatch(chr(c))}
        tried = "ab12,;\u00e9z"
        if [p for p, _ in self.lib.pre_tokenizer.pre_tokenize_str(tried)] != [p.translate(self.symbols) for p in PIECE.findall(tried)]:
            raise ValueError("this tokenizer does not part words by letters, digits and other characters")
        self.special = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        self.tables: dict[str, bytes] = {}
        self.begun: dict[str, int] = {}

    def ask(self, texts: list[str]) -> list[int]:
        out = []
        for k in range(0, len(texts), ASKED):
            out += [len(e) for e in self.lib.encode_batch_fast(texts[k : k + ASKED], add_special_tokens=False)]
        return out

    def _plain(self, text: str) -> list[int]:
        """Counts for i from 1 in a long run without whole special tokens."""
        lowered = [len(self.lib.normalizer.normalize_str(c)) for c in text]
        norm = self.lib.normalizer.normalize_str(text)
        if not unicodedata.is_normalized("NFC", text) or sum(lowered) != len(norm):
            return self.ask([text[:i] for i in range(1, len(text) + 1)])  # quadratic; only for long unspaced text in decomposed form
        at, base = [0] * (len(norm) + 1), 0
        done = 0
        for symbols, (start, stop) in self.lib.pre_tokenizer.pre_tokenize_str(norm):
            for k in range(done + 1, start + 1):
                at[k] = base
            piece = norm[start:stop]
            if len(piece) <= SHORT:
                found = self.ask([piece[:i] for i in range(1, len(piece) + 1)])
            else:
                ends = np.cumsum([len(c.encode()) for c in piece])
                counts = self.bpe.counts(symbols)
                found = [counts[e - 1] for e in ends]
            at[start + 1 : stop + 1] = [base + f for f in found]
            base, done = base + found[-1], stop
        for k in range(done + 1, len(norm) + 1):
            at[k] = base
        return [at[k] for k in np.cumsum(lowered)]

    def long(self, segment: str) -> list[int]:
        out, base, pos = [], 0, 0
        for m in self.special.finditer(segment):
            found = self._plain(segment[pos : m.end() - 1])
            out += [base + f for f in found]
            base += (found[m.start() - pos - 1] if m.start() > pos else 0) + 1
            out.append(base)
            pos = m.end()
        return out + [base + f for f in (self._plain(segment[pos:]) if pos < len(segment) else [])]

    def _word(self, word: str) -> list[int]:
        """Counts for i from 1 in a piece that is one pre-token, as its prefixes are."""
        out = []
        for i in range(1, len(word) + 1):
            start = word[:i]
            n = self.begun.get(start)
            if n is None:
                n = self.begun[start] = len(self.lib.model.tokenize(start.translate(self.symbols)))
            out.append(n)
        return out

    def learn(self, pieces: set[str]) -> None:
        missing = pieces - self.tables.keys()
        if len(self.tables) + len(missing) > REMEMBERED:
            self.tables.clear()
            missing = pieces
        if len(self.begun) > BEGUN:
            self.begun.clear()
        odd = {p for p in missing if len(p) <= SHORT and not WORD.fullmatch(p)}
        new = list({p[:i] for p in odd for i in range(1, len(p) + 1)} - self.begun.keys())
        self.begun.update(zip(new, self.ask(new)))
        for p in missing:
            if len(p) > SHORT:
                self.tables[p] = _pack(self.long(p))
            elif p in odd:
                self.tables[p] = _pack([self.begun[p[:i]] for i in range(1, len(p) + 1)])
            else:
                self.tables[p] = _pack(self._word(p.lower()))

    def prefixes(self, texts: list[str]) -> list[bytes]:
        """Counts at every prefix of every text, the empty one first."""
        split = [PIECE.findall(t) for t in texts]
        self.learn(set(chain.from_iterable(split)))
        out = []
        for text, pieces in zip(texts, split):
            ascii_only = text.isascii()
            chars = np.frombuffer(text.encode("ascii" if ascii_only else "utf-32-le"), dtype="u1" if ascii_only else "<u4")
            solid = (chars != 32) & ((chars < 9) | (chars > 13))
            inner = np.frombuffer(b"".join([self.tables[p] for p in pieces]), dtype="<u4")
            sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
            ends = np.cumsum(sizes)
            closed = np.cumsum(inner[ends - 1], dtype=np.uint32)
            # a piece begins at the count its predecessor closed with; white space keeps the count before it
            counts = np.zeros(len(inner) + 1, dtype=np.uint32)
            counts[1:] = inner + np.repeat(closed - inner[ends - 1], sizes)
            seen = np.zeros(len(chars) + 1, dtype=np.int64)
            np.cumsum(solid, out=seen[1:])
            out.append(counts[seen].astype(">u4").tobytes())
        return out


@lru_cache(maxsize=1)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= SLICE_CHARS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def prefix_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_chars, prefix``: the token count at every prefix of every text.

    ``prefix`` holds one big-endian 32-bit count per code point boundary, from the empty
    prefix to the whole text, as the library counts the prefix for itself. The answer at
    a prefix is the count at the end of its last whole piece plus that of the piece begun,
    which comes from a table per distinct piece. ``tokens_at`` and ``longest_within`` answer
    from it without encoding anything again.

    NULL and empty texts have the one count 0; rows are independent of each other, so
    repeated ids stay repeated; further columns are ignored; no rows give no rows.
    """
    path = tokenizer or default_tokenizer()
    kind = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_chars", T.LongType()), T.StructField("prefix", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in _slices(texts):
                part = texts[a:b]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array([len(t.encode()) for t in part], pa.int64()),
                        pa.array([len(t) for t in part], pa.int64()),
                        pa.array(counter(path).prefixes(part), pa.binary()),
                    ],
                    ["doc_id", "n_bytes", "n_chars", "prefix"],
                )

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, kind)


def tokens_at(prefix: Column, chars: Column) -> Column:
    """Tokens of the first ``chars`` code points."""
    return F.conv(F.hex(F.substr(prefix, (chars * 4 + 1).cast("int"), F.lit(4))), 16, 10).cast("long")


def longest_within(prefix: Column, budget: int) -> Column:
    """Code points of the longest prefix that has at most ``budget`` tokens."""

    @F.arrow_udf("long")
    def longest(column: pa.Array) -> pa.Array:
        return pa.array([None if p is None else int(np.flatnonzero(np.frombuffer(p, ">u4") <= budget)[-1]) for p in column.to_pylist()], pa.int64())

    return longest(prefix)


@query("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents, read off their prefix tables."""
    counts = prefix_table(table(spark, sf_dir, "documents"))
    n = tokens_at(F.col("prefix"), F.col("n_chars"))
    return counts.select("doc_id", "n_bytes", n.alias("n_tokens")).withColumn("over_limit", F.col("n_tokens") > LIMIT)
