import hashlib
import json
import os
import sys
import zlib
from collections import Counter

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))

from fixtures import documents, rows  # noqa: E402

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")

from tonality.llm import byte_bpe, forced_bpe, length_histogram, repair  # noqa: E402

WORD, BYTE = public.path("word_bpe_49k.json"), public.path("byte_bpe_50k.json")
ODD = ["<|endoftext|>", "a<|endoftext|> b", "x\n <|startoftext|>Y", "a  b", " x ", "İSTANBUL ΣΑΣ it's 12 34 á é",
       "don't\t\x1c\x85z <|ENDOFTEXT|>", "aaaaa" * 50, "\n\n w", "　x   y", "’s 's 'S ªº µm ÿŸ", "a\r\nb​c", "é ́",
       "!!!...,,,", "wo.rd,s", "ñandú’s", "ǅ ﬁ ß"]


def reference(path):
    t = tokenizers.Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def packed(ids):
    return np.asarray(ids, "<u4").tobytes()


def test_word_encoder_is_the_librarys():
    ours, lib = forced_bpe.ForcedBPE(open(WORD, encoding="utf-8").read()), reference(WORD)
    texts = [t or "" for _, t in rows()] + ODD
    for text, ids in zip(texts, ours.encode(texts)):
        want = lib.encode(text, add_special_tokens=False).ids
        assert ids == packed(want), text[:80]
        assert ours.decode(ids) == lib.decode(want, skip_special_tokens=False)


def test_cuts_only_where_no_token_spans():
    ours = forced_bpe.ForcedBPE(open(WORD, encoding="utf-8").read())
    vocab = json.load(open(WORD, encoding="utf-8"))["model"]["vocab"]
    bodies = [t.removesuffix("</w>") for t in vocab]
    cut = ours.cut("qzxqj12vw")
    assert "".join(cut) == "qzxqj12vw" and len(cut) > 1
    for a, b in zip(cut, cut[1:]):
        assert not any(a[-1] + b[0] in t for t in bodies)


def test_small_caches_give_the_same(monkeypatch):
    texts = [t or "" for _, t in rows()]
    config = open(WORD, encoding="utf-8").read()
    want = list(forced_bpe.ForcedBPE(config).encode(texts))
    monkeypatch.setattr(forced_bpe, "CACHE_PIECES", 5)
    assert list(forced_bpe.ForcedBPE(config).encode(texts)) == want


def test_splitting_of_spaces_and_marks_is_the_librarys():
    import random
    enc, rng = byte_bpe.ByteEncoder(open(BYTE, encoding="utf-8").read()), random.Random(3)
    texts = ["".join(rng.choice(" \n\t\r\u3000'sltvremdS\u00e91\u0662.-,x\u0085\u200b\u2603") for _ in range(rng.randint(0, 14)))
             for _ in range(5000)]
    got = [list(np.frombuffer(b, "<u4")) for b in enc.encode(texts)]
    assert got == [enc.tok.encode(s, add_special_tokens=False).ids for s in texts]


def test_byte_encoder_is_the_librarys():
    ours, lib = byte_bpe.ByteEncoder(open(BYTE, encoding="utf-8").read()), reference(BYTE)
    texts = [t or "" for _, t in rows()] + ODD
    for text, ids in zip(texts, ours.encode(texts)):
        assert ids == packed(lib.encode(text, add_special_tokens=False).ids), text[:80]


def test_splitting_without_looking_ahead_is_the_librarys():
    import random
    enc, rng = byte_bpe.ByteEncoder(open(BYTE, encoding="utf-8").read()), random.Random(5)
    parts = [" ", "\n", "\t ", "\n\n", "\u3000", "\x85", "\xa0 ", "\x1c", "\u2028", "\u200b", "it's", "'ll", "\u00e9l", "12", "\u0662", ".,", "\u2603"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(5000)]
    near = [t for t in texts if not byte_bpe.SPACES.search(t)]
    assert 1000 < len(near) < 4000 and sum("\n\n" in t for t in near) > 100
    assert [enc.near.encode_ordinary(t) for t in near] == [enc.tok.encode(t, add_special_tokens=False).ids for t in near]
    got = [list(np.frombuffer(b, "<u4")) for b in enc.encode(texts)]
    assert got == [enc.tok.encode(t, add_special_tokens=False).ids for t in texts]


def _other_files():
    spec = json.load(open(BYTE, encoding="utf-8"))
    assert byte_bpe.is_plain(spec)
    def changed(**parts):
        return {**spec, **parts}
    prefix = changed(pre_tokenizer={**spec["pre_tokenizer"], "add_prefix_space": True})
    whole = changed(pre_tokenizer={**spec["pre_tokenizer"], "use_regex": False})
    digits = changed(pre_tokenizer={"type": "Sequence", "pretokenizers": [
        {"type": "Digits", "individual_digits": True}, spec["pre_tokenizer"]]})
    lower = changed(normalizer={"type": "Lowercase"})
    merges = list(spec["model"]["merges"])
    merges[10], merges[400] = merges[400], merges[10]
    order = changed(model={**spec["model"], "merges": merges})
    return {"prefix": prefix, "whole": whole, "digits": digits, "lower": lower, "order": order}


@pytest.mark.parametrize("name", ["prefix", "whole", "digits", "lower", "order"])
def test_files_with_other_settings_go_to_the_library(name):
    from tokenizers import Tokenizer
    spec = _other_files()[name]
    assert not byte_bpe.is_plain(spec)
    text = json.dumps(spec)
    ours, lib = byte_bpe.ByteEncoder(text), Tokenizer.from_str(text)
    texts = ["Some 1234 words, AND more\n then", *[t[:3000] for t in ODD], "", "x"]
    for t, ids in zip(texts, ours.encode(texts)):
        assert ids == packed(lib.encode(t, add_special_tokens=False).ids)


@pytest.mark.parametrize("unit", [[5], [1, 2], [1, 2, 3], list(range(8))])
def test_runs_shrink_to_about_their_logarithm(unit):
    a = np.tile(np.array(unit, np.uint32), 16_000 // len(unit))
    shard = repair.Shard(repair.compress(a, np.array([len(a)])))
    assert len(shard.seq) <= 2 * repair.LEAST_USES + 2 and len(shard.left) <= 2 * len(unit) + 16
    assert (shard.expand(shard.seq) == a).all() and (shard.ids(7001, 7043) == a[7001:7043]).all()


def test_later_rounds_look_only_at_places_that_may_be_frequent(monkeypatch):
    rng = np.random.default_rng(7)
    phrases = [rng.integers(0, 20_000, 6) for _ in range(400)]
    ids = np.concatenate([np.concatenate([phrases[p], rng.integers(0, 20_000, 4)]) for p in rng.zipf(1.3, 9000) % 400])
    looked, slots = [], repair._slots
    monkeypatch.setattr(repair, "_slots", lambda pair: (looked.append(len(pair)), slots(pair))[1])
    shard = repair.Shard(repair.compress(ids.astype(np.uint32), np.arange(1000, len(ids) + 1, 1000)))
    assert len(shard.rounds) >= 4 and (shard.expand(shard.seq) == ids).all()
    assert sum(looked) < 2.5 * len(ids)                   # all places in each round: 4.3 times the ids


def test_runs_of_one_id_are_cut_at_the_ends_of_documents():
    a, ends = np.full(24, 5, np.uint32), np.array([e for i in range(0, 24, 3) for e in (i + 1, i + 3)])
    shard = repair.Shard(repair.compress(a, ends))         # eight documents of two ids, apart by one of one id
    assert len(shard.left) == 1 and len(shard.seq) == 16
    assert [shard.document(i).tolist() for i in range(4)] == [[5], [5, 5], [5], [5, 5]]


def test_no_frequent_pair_is_left_and_ids_take_less_than_two_bytes():
    import pandas as pd

    enc = byte_bpe.ByteEncoder(open(BYTE, encoding="utf-8").read())
    docs = pd.read_parquet("/root/testdata/sf0.01/documents.parquet").sort_values("doc_id")
    blobs = [b + (2).to_bytes(4, "little") for b in enc.encode(t or "" for t in docs.text)]
    ids, ends = np.frombuffer(b"".join(blobs), "<u4"), np.cumsum([len(b) // 4 for b in blobs])
    payload = repair.compress(ids, ends)
    shard = repair.Shard(payload)
    assert len(payload) < 1.5 * len(ids) and (shard.expand(shard.seq) == ids).all()
    inside = np.ones(len(shard.seq), bool)
    inside[shard.sym_ends[shard.sym_ends > 0].astype(np.int64) - 1] = False
    left = Counter()
    before = None
    for i in np.flatnonzero(inside[:-1]):
        pair = (shard.seq[i], shard.seq[i + 1])
        if before == (i - 1, pair):                # overlaps the place before
            before = None
            continue
        left[pair] += 1
        before = (i, pair)
    assert max(left.values()) < repair.LEAST_USES


@pytest.mark.parametrize("bits", [1, 3, 8, 17, 25, 32])
def test_packing(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 7, 1000):
        v = rng.integers(0, 2 ** bits, n, dtype=np.uint64).astype(np.uint32)
        data = np.frombuffer(repair._pack(v, bits), np.uint8)
        assert len(data) == repair._packed_bytes(n, bits) and (repair._unpack(data, n, bits) == v).all()


def test_round_trip_query_columns(spark):
    lib = reference(WORD)
    out = forced_bpe.round_trip(documents(spark), WORD).collect()
    want = sorted((r[0] or -1, packed(lib.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows())
    assert sorted((r.doc_id or -1, bytes(r.ids)) for r in out) == want
    again = forced_bpe.decode(forced_bpe.encode(documents(spark), WORD), WORD).collect()
    assert sorted((r.doc_id or -1, r.text) for r in again) == sorted((r.doc_id or -1, r.text) for r in out)
    assert forced_bpe.round_trip(documents(spark, []), WORD).count() == 0


def test_token_files(spark, tmp_path):
    lib = reference(BYTE)
    path = repair.write(documents(spark), BYTE, str(tmp_path / "tokens"))
    got = sorted(((r.start, r.n_tokens, r.doc_id, bytes(r.ids)) for r in repair.read(spark, path).collect()))
    want = [(i, packed([*lib.encode(t or "", add_special_tokens=False).ids, 2])) for i, t in rows()]
    assert [g[0] for g in got] == [0, *np.cumsum([g[1] for g in got])[:-1]]
    keys = [-1 if g[2] is None else g[2] for g in got]
    assert keys == sorted(keys)
    assert sorted((str(g[2]), g[3]) for g in got) == sorted((str(i), b) for i, b in want)
    assert all(g[1] * 4 == len(g[3]) for g in got)
    empty = repair.write(documents(spark, []), BYTE, str(tmp_path / "none"))
    assert repair.read(spark, empty).count() == 0


@pytest.mark.parametrize("ids", [[], [7], [5, 5, 5, 5, 5, 5, 5, 5, 5] * 60, [1, 2, 3, 4] * 500, list(range(3000)), [0, 0] * 900])
def test_grammar_round_trip_and_random_access(ids):
    a = np.array(ids, np.uint32)
    ends = np.array([0, len(a) // 3, len(a) // 3, len(a)])
    shard = repair.Shard(repair.compress(a, ends))
    assert (shard.expand(shard.seq) == a).all()
    for i, (lo, hi) in enumerate(zip([0, *ends[:-1]], ends)):
        assert (shard.document(i) == a[lo:hi]).all()
    for lo, hi in ((0, 3), (len(a) // 2, len(a) // 2 + 40), (len(a) - 2, len(a) + 5), (4, 4)):
        assert (shard.ids(lo, hi) == a[max(0, lo):hi]).all()


def test_repetitions_become_rules():
    a = np.tile(np.arange(8, dtype=np.uint32), 2000)
    payload = repair.compress(a, np.array([len(a)]))
    assert len(repair.Shard(payload).seq) < len(a) / 50
    assert zlib.crc32(repair.Shard(payload).document(0).astype("<u4").tobytes()) == zlib.crc32(a.tobytes())


def test_histogram_answers(spark, monkeypatch):
    monkeypatch.setattr(length_histogram, "SPAN", 50)
    lib = reference(BYTE)
    lengths = [len(lib.encode(t or "", add_special_tokens=False).ids) for _, t in rows()]
    per_doc = length_histogram.token_lengths(documents(spark), BYTE)
    hist = length_histogram.histogram(per_doc)
    sums = length_histogram.suffix_sums(hist)
    got = {r.n_tokens: r for r in sums.collect()}
    assert set(got) == set(lengths)
    for n, r in got.items():
        assert r.docs == lengths.count(n)
        assert r.docs_longer == sum(x > n for x in lengths) and r.tokens_longer == sum(x for x in lengths if x > n)
        assert r.docs_upto == sum(x <= n for x in lengths) and r.tokens_upto == sum(x for x in lengths if x <= n)
        assert r.truncated_total == sum(min(x, n) for x in lengths)
    cut = {r.context_limit: r.tokens for r in length_histogram.truncated_totals(hist, [0, 10, 777]).collect()}
    assert cut == {c: sum(min(x, c) for x in lengths) for c in (0, 10, 777)}
    assert length_histogram.quantile(sums, 0.5).first()[0] == sorted(lengths)[-(-len(lengths) // 2) - 1]
    assert length_histogram.suffix_sums(length_histogram.histogram(
        length_histogram.token_lengths(documents(spark, []), BYTE))).count() == 0


def test_sha_of_empty_text_is_that_of_no_bytes(spark):
    from pyspark.sql import functions as F

    row = forced_bpe.round_trip(documents(spark, [(1, None)]), WORD).select(F.sha2("ids", 256), F.sha2(F.encode("text", "UTF-8"), 256)).first()
    assert row[0] == row[1] == hashlib.sha256(b"").hexdigest()
