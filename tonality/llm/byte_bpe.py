"""Token ids of a byte-level BPE vocabulary file, as the tokenizers library gives them.

Whole texts are encoded with the file's own vocabulary as ranks by tiktoken,
about four times faster than the tokenizers library and with the same ids;
texts that hold a special token's string go to the tokenizers library.  So does
every text if the file's settings are not those that the fast way stands for
(``is_plain``): another splitting, a normaliser, a space before the text, merges that are not in
the order of their ids.  Tests hold all ways against the library.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterable, Iterator

from pyspark import Broadcast
from pyspark.sql import SparkSession

from tonality.llm.forced_bpe import byte_alphabet

# Fixed value: the splitting pattern of byte-level vocabularies of this kind, in tiktoken's public form
# without backtracking; its parts are those of 's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
# The same parts without looking ahead, which an automaton finds faster, for texts where SPACES finds nothing:
# only runs of three white-space characters, and of two at the end, have a part of several such characters
NEAR_SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"
SPACES = re.compile(r"\s\s(?:\s|\Z)")

_ENCODERS: dict[str, "ByteEncoder"] = {}


def load(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary file's text, read once on the driver and shipped (a fixed size, 1.5 MB)."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def encoder(config: Broadcast) -> "ByteEncoder":
    """The worker's encoder for this vocabulary (kept between tasks)."""
    key = hashlib.sha256(config.value.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS[key] = ByteEncoder(config.value)
    return _ENCODERS[key]


def is_plain(spec: dict) -> bool:
    """Whether a file splits by ``SPLIT`` alone and merges byte pairs in the order of the merged tokens' ids."""
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space", True) or not pre.get("use_regex", True):
        return False
    odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    if model.get("type", "BPE") != "BPE" or any(model.get(k) for k in odd):
        return False
    merged = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [model["vocab"].get(a + b, -1) for a, b in merged]
    plain_tokens = sum(len(t) == 1 for t in model["vocab"])
    special = {t["content"] for t in spec.get("added_tokens", [])}
    known = sum(t in model["vocab"] for t in special if len(t) > 1)
    return (made == sorted(made) and len(set(made)) == len(made) and (not made or made[0] >= 0)
            and len(made) + plain_tokens + known == len(model["vocab"]))


class ByteEncoder:
    """Encoder of one vocabulary file; the bytes of the result are little-endian unsigned 32-bit ids."""

    def __init__(self, config: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(config)
        self.tok.no_truncation()
        self.tok.no_padding()
        added = self.tok.get_added_tokens_decoder()
        self.special = re.compile("|".join(re.escape(t.content) for t in added.values()) or r"(?!)")
        self.plain = is_plain(json.loads(config))
        if not self.plain:
            return
        back = {c: b for b, c in byte_alphabet().items()}
        ranks = {bytes(back[c] for c in t): i for t, i in self.tok.get_vocab(False).items() if i not in added}
        self.ranks, self.near = (tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
                                 for name, pattern in (("ranks", SPLIT), ("near", NEAR_SPLIT)))

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each whole text, in order."""
        for text in texts:
            if not self.plain or self.special.search(text):
                ids = self.tok.encode(text, add_special_tokens=False).ids
            else:
                ids = (self.ranks if SPACES.search(text) else self.near).encode_ordinary(text)
            yield struct.pack(f"<{len(ids)}I", *ids)
