from __future__ import annotations

import json
import random
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from marmita.llm import token_output as t

PATH = public_tokenizers.path("byte_bpe_50k.json")
DDL = "doc_id LONG, text STRING, shard LONG, n_tokens STRING"
BITS = ["a", "b ", " c", "  ", "\n", " \n", "\t", "the", " cat's", "'s", "12", "é", "漢", "🙂", "!!", "\x1c", "\x85", "\xa0", " ", "<|", "un",
        "\r\n", "'ll ", "   ", ".", " ", "dogs' ", "9%. ", "x### ", "_* ", "²) "]


def texts(n, seed=0):
    rng = random.Random(seed)
    return ["".join(rng.choices(BITS, k=rng.randrange(40))) for _ in range(n)]


def test_units_have_the_ids_of_the_whole():
    plain = Tokenizer.from_file(PATH)
    encoder = t.Encoder(PATH)
    some = texts(5000) + ["", " ", "  ", "\n", " a", "a ", "the the the", "x 's it's"]
    want = [e.ids for e in plain.encode_batch(some, add_special_tokens=False)]
    assert [x.tolist() for x in encoder.encode(some)] == want
    # What was learned from one text holds in the next.
    few = t.Encoder(PATH)
    assert [few.encode([x])[0].tolist() for x in some] == want


def test_words_lines_and_letters_of_all_kinds():
    """Words of Latin and other letters, joined by newlines, closed by marks, with digits or control strings in them."""
    rng = random.Random(9)
    letters = ["abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "àéîõüßÆøłžſƀɏ", "ɐʰͰабвЖ", "漢字かなカナ", "ªºµ", "١٢٣४५", "Აꟊ𞤀𝄞"]
    word = lambda: "".join(rng.choices(letters[min(len(letters) - 1, int(rng.expovariate(1)))], k=rng.randrange(1, 14)))
    ends = ["", "", "", ",", ".", "'s", "'", "!?", "\n" + word(), ".\n" + word() + ",", "\n\n" + word(), "1", "<|endoftext|>", "'ll\n" + word(), "\n's"]
    some = [" ".join(word() + rng.choice(ends) for _ in range(rng.randrange(12))) for _ in range(6000)]
    want = [e.ids for e in Tokenizer.from_file(PATH).encode_batch(some, add_special_tokens=False)]
    encoder = t.Encoder(PATH)
    assert [x.tolist() for i in range(0, 6000, 500) for x in encoder.encode(some[i:i + 500])] == want
    assert encoder.encode([]) == []


def test_a_tokenizer_of_another_pattern_encodes_whole_texts(tmp_path):
    stated = json.loads(Path(PATH).read_text(encoding="utf-8"))
    some = texts(500) + ["the cat's 12 dogs, all of them. "]
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}},
                   {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}}):
        path = str(tmp_path / "other.json")
        Path(path).write_text(json.dumps(stated | change), encoding="utf-8")
        assert not t.known_pattern(path)
        want = [e.ids for e in Tokenizer.from_file(path).encode_batch(some, add_special_tokens=False)]
        assert [x.tolist() for x in t.Encoder(path).encode(some)] == want
    assert t.known_pattern(PATH)


@pytest.mark.parametrize("seed", range(6))
def test_grammar_round_trip(seed):
    rng = np.random.default_rng(seed)
    alphabet = [2, 3, 50, 400, 3, 1][seed]
    parts = [rng.integers(0, alphabet, n) for n in rng.integers(1, 4000, 30)]
    parts += [np.zeros(5000, int), np.array([alphabet - 1])]
    lengths = [len(p) for p in parts]
    block = t._written(7, 3, list(range(len(parts))), [p.astype(np.uint32) for p in parts], alphabet).to_pylist()[0]
    symbols, offsets, stored, rules, expanded = t.unpacked(block)
    assert stored.tolist() == lengths and len(rules) and block["n_tokens"] == sum(lengths)
    assert len(symbols) < sum(lengths) and offsets[-1] == len(symbols)
    assert (t.decoded(symbols, rules, block["base"]) == np.concatenate(parts)).all()
    for i in (0, 5, 30, 31):
        assert t.tokens_of(block, i).tolist() == parts[i].tolist()
        a, b = sorted(rng.integers(0, lengths[i] + 1, 2))
        assert t.tokens_of(block, i, a, b).tolist() == parts[i][a:b].tolist()


@pytest.mark.parametrize("block", [1 << 20, 500])
def test_files(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(t, "BLOCK_TOKENS", block)
    rows = [(i * 2, x, 1, "s") for i, x in enumerate(texts(400, 1))]
    rows += [(5, None, 1, "s"), (6, "twice", 1, "s"), (6, "twice", 1, "s"), (None, "no id", 1, "s"), (3001, "long words " * 100_000, 1, "s")]
    random.Random(2).shuffle(rows)
    t.write_tokens(spark.createDataFrame(rows, DDL).repartition(5), str(tmp_path / "x"), PATH)
    got = t.documents_of(t.read_blocks(spark, str(tmp_path / "x"))).collect()
    plain, at = Tokenizer.from_file(PATH), 0
    assert len(got) == len(rows)
    text = {}
    for doc_id, x, *_ in rows:
        text.setdefault(doc_id, []).append(x or "")
    for r in sorted(got, key=lambda r: r.start):
        options = {(len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
                   for x in text[r.doc_id] for ids in [plain.encode(x, add_special_tokens=False).ids + [2]]}
        assert (r.n_tokens, r.ids_crc32) in options and r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))


def test_empty(spark, tmp_path):
    t.write_tokens(spark.createDataFrame([], DDL), str(tmp_path / "x"), PATH)
    assert t.documents_of(t.read_blocks(spark, str(tmp_path / "x"))).collect() == []


def test_no_frequent_pair_is_left():
    rng = np.random.default_rng(9)
    ids = (rng.zipf(1.2, 200_000) % 3000).astype(np.uint32)
    starts = np.arange(0, len(ids) + 1, 100)
    symbols, offsets, rules = t.repair(ids, starts, 3000)
    assert (t.decoded(symbols, rules, 3000) == ids).all() and len(set(map(tuple, rules.tolist()))) == len(rules)
    for part in (symbols, ids):
        at = offsets if part is symbols else starts
        pairs = {}
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            last = None
            for i in range(a, b - 1):
                pair = int(part[i]), int(part[i + 1])
                if last != (i - 1, pair):  # a pair of equal symbols overlaps itself
                    pairs[pair] = pairs.get(pair, 0) + 1
                    last = i, pair
        if part is symbols:
            assert max(pairs.values()) < t.LEAST
        else:  # the most frequent pairs of the tokens get the first rules
            best = max(pairs, key=lambda p: (pairs[p], (-p[0], -p[1])))
            assert tuple(rules[0].tolist()) == best


def test_a_word_is_learned_once_for_all_marks_and_lines():
    encoder, some = t.Encoder(PATH), ["x word word, word. word!?\nword; word\nüber übé's übé", "y word\" word's"]
    want = [e.ids for e in Tokenizer.from_file(PATH).encode_batch(some, add_special_tokens=False)]
    assert [x.tolist() for x in encoder.encode(some)] == want
    assert set(encoder.spaced) == {"x", "y", "word", "word's", "übé", "übé's"}


def test_every_character_at_the_ends_of_words():
    some = [f"a {c}b b{c} {c}, b{c}. {c} b{c}\nb, b.\n{c}b" for c in map(chr, [*range(1, 0x2100), 0x3000, 0x6f22, 0x1d11e])]
    want = [e.ids for e in Tokenizer.from_file(PATH).encode_batch(some, add_special_tokens=False)]
    encoder = t.Encoder(PATH)
    assert [encoder.encode([x])[0].tolist() for x in some] == want
    assert [x.tolist() for x in t.Encoder(PATH).encode(some)] == want


def test_later_rounds_count_touched_places_only(monkeypatch):
    counted, count = [], t.frequent_pairs
    monkeypatch.setattr(t, "frequent_pairs", lambda symbols, at: counted.append((len(symbols), len(at))) or count(symbols, at))
    ids = (np.random.default_rng(3).zipf(1.2, 100_000) % 3000).astype(np.uint32)
    t.repair(ids, np.arange(0, len(ids) + 1, 100), 3000)
    assert counted[0] == (100_000, 99_000) and len(counted) > 3
    assert counted[-1][1] < counted[-1][0] / 10
