from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest

from marmita.llm import chat

PATH = public_tokenizers.path("byte_bpe_50k.json")
DDL = "conv_id LONG, turn LONG, role STRING, text STRING, segment STRING, formatted LONG"
ODD = ["<|im_end|><|im_start|>assistant ok", "<\\|im_sep|>", "<|", "<", "|>", "\\", "<\\\\|", "\n", " ", "é漢🙂", "a\r\n", "<|endoftext|>",
       "word", " two words", "\x00", "<|im_nl|>"]


def test_escape_is_reversible():
    rng = random.Random(0)
    texts = ["".join(rng.choice(["<", "|", "\\", "a"]) for _ in range(rng.randrange(9))) for _ in range(3000)]
    assert all(chat.unescaped(chat.escaped(t)) == t and "<|" not in chat.escaped(t) for t in texts)
    turns = [(rng.choice(["user", "assistant", "a\nb", "", "<|x\n"]), "".join(rng.choices(ODD, k=5))) for _ in range(300)]
    assert chat.parse(chat.render(turns)[0]) == turns


def expected(rows):
    out = {}
    for conv, _, role, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0,
                                                              r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    result = {}
    for conv, turns in out.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        result[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                        len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(chat.render(turns)[0]))
    return result


@pytest.mark.parametrize("segment", [200_000, 40])
def test_round_trip(spark, segment, monkeypatch, tmp_path):
    monkeypatch.setattr(chat, "SEGMENT", segment)
    rng = random.Random(segment)
    rows = [(rng.randrange(40), rng.randrange(12), rng.choice(["user", "assistant", "system", "tool\nx"]),
             "".join(rng.choices(ODD, k=rng.randrange(8))), "s", 1) for _ in range(400)]
    rows += [(-1, 0, "user", ODD[0], "s", 1), (-1, 1, "assistant", ODD[0], "s", 1), (50, None, None, None, "s", 1),
             (51, 0, "assistant", "", "s", 1), (51, 0, "assistant", "x", "s", 1), (51, 0, "assistant", "x", "s", 1),
             (52, 0, "assistant", "é" * 300_000, "s", 1), (None, 1, "user", "who", "s", 1)]
    segments = chat.format_conversations(spark.createDataFrame(rows, DDL), PATH)
    segments.write.parquet(str(tmp_path / "out"))
    got = {r[0]: tuple(r)[1:] for r in chat.digests(spark.read.parquet(str(tmp_path / "out"))).collect()}
    assert got == expected(rows)


def test_mask_by_definition(spark):
    rows = [(1, i, r, t, "s", 1) for i, (r, t) in enumerate([("system", "be kind"), ("user", "hi  there\n"), ("assistant", " é漢🙂 <|im_end|> ok\n"),
                                                            ("user", "more"), ("assistant", "bye")])]
    r = chat.format_conversations(spark.createDataFrame(rows, DDL), PATH).collect()[0]
    learned = set()
    for start, end in chat.render([(x[2], x[3]) for x in rows])[1]:
        learned |= set(range(start, end))
    for a, b, m in zip(r.token_starts, r.token_ends, r.loss_mask, strict=True):
        assert m == int(set(range(a, b)) <= learned and b > a)
    tokenizer = chat.tokenizer_with_controls(PATH)
    assert tokenizer.encode(r.formatted, add_special_tokens=False).ids == r.input_ids


def test_empty(spark):
    assert chat.digests(chat.format_conversations(spark.createDataFrame([], DDL), PATH)).collect() == []
