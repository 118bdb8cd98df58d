"""BPE encoding by forced boundaries, and decoding.

A byte pair that occurs inside no vocabulary token can never be joined by a
merge, so a word is cut for certain between such bytes.  The fragments are
encoded independently and their ids concatenated: the result is the
library's, and short fragments repeat far more often than words, so each is
encoded once per worker.

The splitting of a text into words (normaliser, pattern, special tokens) is
the vocabulary file's own; text is cut at spaces and line ends first, which
the pattern drops.  Only a word's last fragment carries the end-of-word mark.

Null and empty texts encode to no ids and decode to an empty text; repeated
rows and null keys are kept as they are; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from tonality.llm.common import cast_like, clean_strings, workers_import

CACHE_PIECES = 100_000   # entries a worker keeps by piece, word and fragment
SLICE = 500              # rows a worker holds results of

# Fixed value: the splitting pattern of the vocabulary file that the shortcut below is proven for.
LETTERS_THEN_MARKS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
MARKS = ".,!?;:%&#$*"

_CODECS: dict[str, "ForcedBPE"] = {}


def byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the rest counts on from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


def load(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary file's text, read once on the driver and shipped (a fixed size, 1.7 MB)."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def codec(config: Broadcast) -> "ForcedBPE":
    key = hashlib.sha256(config.value.encode()).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = ForcedBPE(config.value)
    return _CODECS[key]


class ForcedBPE:
    """Encoder and decoder of one vocabulary file with word-end marks."""

    def __init__(self, config: str):
        from tokenizers import Tokenizer, models

        spec = json.loads(config)
        model = spec["model"]
        self.tok = Tokenizer.from_str(config)
        self.mark = model["end_of_word_suffix"] or ""
        vocab = {t: i for t, i in model["vocab"].items()}
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        # the same merges twice: words' last fragments with the mark, all others without
        self.last = models.BPE(vocab=vocab, merges=merges, end_of_word_suffix=self.mark) if self.mark \
            else models.BPE(vocab=vocab, merges=merges)
        self.inner = models.BPE(vocab=vocab, merges=merges)
        inside = set()
        for token in vocab:
            body = token[:-len(self.mark)] if self.mark and token.endswith(self.mark) else token
            inside.update(body[i:i + 2] for i in range(len(body) - 1))
        self.inside = inside
        self.specials = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None
        size = 1 + max([*vocab.values(), *self.specials.values()])
        self.names: list[bytes] = [b""] * size
        for token, i in [*vocab.items(), *self.specials.items()]:
            self.names[i] = token.encode()
        self.pieces = _Filled(self._piece)
        self.words = _Filled(self.word)
        self.inner_ids = _Filled(lambda text: self._merge(self.inner, text))
        alphabet = byte_alphabet()
        self.alphabet = str.maketrans({chr(b): c for b, c in alphabet.items()})
        steps = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        split = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0].get("pattern", {}).get("Regex", "")
        # Latin-1 letters, then plain marks: under this file's rules two words and nothing else
        self.plain = steps == ["NFC", "Replace", "Lowercase"] and split == LETTERS_THEN_MARKS

    def cut(self, word: str) -> list[str]:
        """Fragments of a word (in the vocabulary's byte alphabet) between forced boundaries."""
        inside = self.inside
        at = [i for i in range(1, len(word)) if word[i - 1:i + 1] not in inside]
        return [word[a:b] for a, b in zip([0, *at], [*at, len(word)])] if at else [word]

    @staticmethod
    def _merge(model, fragment: str) -> bytes:
        ids = [t.id for t in model.tokenize(fragment)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def word(self, word: str) -> bytes:
        """Ids of a word: its fragments' ids, concatenated."""
        *front, end = self.cut(word)
        return b"".join(map(self.inner_ids.__getitem__, front)) + self._merge(self.last, end)

    def _piece(self, piece: str) -> bytes:
        """Ids of a space-free piece of a text."""
        if self.plain:
            body = piece.rstrip(MARKS)
            if body.isalpha() and max(body) <= "ÿ":
                low = body.lower()
                ids = self.words[low if low.isascii() else low.encode().decode("latin-1").translate(self.alphabet)]
                return ids if body == piece else ids + self.words[piece[len(body):]]
        out: list[bytes] = []
        for part in (self.special_split.split(piece) if self.special_split else [piece]):
            if part in self.specials:
                out.append(struct.pack("<I", self.specials[part]))
            elif part:
                clean = self.tok.normalizer.normalize_str(part) if self.tok.normalizer else part
                out += [self.words[w] for w, _ in self.tok.pre_tokenizer.pre_tokenize_str(clean)]
        return b"".join(out)

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each whole text."""
        known = self.pieces
        for text in texts:
            yield b"".join(map(known.__getitem__, text.replace("\n", " ").split(" ")))

    def decode(self, ids: bytes) -> str:
        """The text of the ids: the file names no decoder, so the tokens' own strings, joined by a space."""
        names = self.names
        return b" ".join([names[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode()


class _Filled(dict):
    """Ids by text, filled as texts come; emptied beyond ``CACHE_PIECES``."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, text: str) -> bytes:
        if len(self) > CACHE_PIECES:
            self.clear()
        self[text] = ids = self.encode(text)
        return ids


def _mapped(df: DataFrame, vocab_path: str, key: str, col: str, run, columns: str) -> DataFrame:
    """``run(codec, column) -> columns`` over slices of a batch, so that large results leave a worker early."""
    spark = df.sparkSession
    workers_import(spark)
    config = load(spark, vocab_path)
    kind = dict(df.dtypes)[key]
    names = ["key", *[c.split()[0] for c in columns.split(", ")]]

    def batches(it):
        c = codec(config)
        for b in it:
            for i in range(0, b.num_rows, SLICE):
                part = b.slice(i, SLICE)
                yield pa.RecordBatch.from_arrays([part.column(0), *run(c, part.column(1))], names)

    return cast_like(df, key, col).mapInArrow(batches, f"key {kind}, {columns}").withColumnRenamed("key", key)


def encode(docs: DataFrame, vocab_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, ids binary)``: each whole text's ids as little-endian unsigned 32-bit integers."""
    def run(c: ForcedBPE, col: pa.Array) -> list[pa.Array]:
        return [pa.array(list(c.encode(s.as_py() for s in clean_strings(col))), pa.binary())]

    return _mapped(docs, vocab_path, key, text, run, "ids binary")


def decode(ids: DataFrame, vocab_path: str, key: str = "doc_id", col: str = "ids") -> DataFrame:
    """``(key, text string)``: the ids' text; null ids decode to an empty text."""
    def run(c: ForcedBPE, blobs: pa.Array) -> list[pa.Array]:
        return [pa.array([c.decode(x.as_py() or b"") for x in blobs], pa.string())]

    return _mapped(ids, vocab_path, key, col, run, "text string")


def round_trip(docs: DataFrame, vocab_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, ids binary, text string)``: encoded and decoded by one worker, which holds the vocabulary once."""
    def run(c: ForcedBPE, col: pa.Array) -> list[pa.Array]:
        ids = list(c.encode(s.as_py() for s in clean_strings(col)))
        return [pa.array(ids, pa.binary()), pa.array([c.decode(x) for x in ids], pa.string())]

    return _mapped(docs, vocab_path, key, text, run, "ids binary, text string")
