"""Token ids as grammar-compressed binary blocks.

Documents in ascending order of their ids are encoded, cut into blocks of whole documents and compressed by Re-Pair: in rounds,
the pairs of neighbouring symbols that are frequent in the block are replaced by new symbols, until none is frequent.  No pair reaches over the end of a document, so
each document can be decoded alone, and the stored expansion lengths let a reader skip to any of its tokens.

Format: a folder of Parquet files, one row a block.  ``shard`` and ``block`` order the rows, ``n_tokens`` counts all tokens of one.  Binary columns are little-endian:
``offsets`` (uint32, first symbol of each document, and the end), ``lengths`` (uint32, tokens of each document), ``rules`` (uint32 pairs; rule i
defines symbol ``base`` + i), ``expansions`` (uint32, tokens of each rule's symbol), ``symbols`` (uint16 or uint32, by ``width``).
"""

from __future__ import annotations

import json
import re
import sys
import types
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A block is closed once it has so many tokens; also what a task keeps in memory.
BLOCK_TOKENS = 1 << 20
#: The least count of a pair that is replaced.
LEAST = 24
SLOT_BITS = 18
#: Units that a worker remembers, about 200 bytes each, and how many are encoded as one text.
MEMO_UNITS = 1_400_000
LINES = 1000
ENCODED_TOGETHER = 1 << 22

BLOCKS = ("shard long, block long, n_tokens long, doc_ids array<long>, base long, width int, offsets binary, lengths binary, rules binary, "
          "expansions binary, symbols binary")

MARKS = ".,;:!?#%&*$|\"')"
#: Code points from here on are left to the tokenizer's own table of letters.
AFTER_LATIN = "\u0250"
#: How byte-level models spell the 256 bytes: printable ones as themselves, the others as code points from 256 on.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
SPELLED = {b: chr(b) for b in PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)).difference(PRINTABLE)))}
#: All of a text up to the marks at its end.
NOT_CLOSING = r"(?s)^.*[^.,;:!?#%&*$|\"')]"
#: First bytes of characters that are not white space, and ASCII letters and digits.
BEGINS, ENDS = np.zeros(256, bool), np.zeros(256, bool)
BEGINS[0x21:0x7F] = BEGINS[0xC3:0xE0] = True
ENDS[[b for b in range(128) if chr(b).isalnum()]] = True
LONE_SPACE = re.compile(r"(?<!\s) (?!\s)")


def beside_space(unit: str) -> bool:
    return not unit or unit[0].isspace() or unit[-1].isspace()


def known_pattern(tokenizer_json: str) -> bool:
    """Whether the tokenizer cuts texts as ``Encoder`` relies on: byte-level pieces by the usual pattern, nothing before it, no greedy added tokens."""
    with open(tokenizer_json, encoding="utf-8") as file:
        stated = json.load(file)
    pieces = stated.get("pre_tokenizer") or {}
    return (stated.get("normalizer") is None and pieces.get("type") == "ByteLevel" and pieces.get("use_regex") is True
            and pieces.get("add_prefix_space") is False
            and all(not t["lstrip"] and not t["rstrip"] and not any(c.isspace() for c in t["content"]) for t in stated.get("added_tokens", [])))


class Encoder:
    """Ids of whole texts with a byte-level BPE tokenizer, each distinct unit encoded once.

    The tokenizer's own pattern starts a new piece at a single space between two visible characters, so a text cut there has the ids of its
    units in a row.  White space next to a space is not cut.  New units are encoded together as lines of one text, since a
    newline before a visible character or a space is a piece of its own.  Units are found, and their ids laid out, by columns; only units that
    are new to a batch are looked at one by one.  A tokenizer of another pattern encodes whole texts.
    """

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_json)
        self.newline = self._ids(["\n"])[0].tolist()
        self.model = self.tokenizer.model
        self.cuts = known_pattern(tokenizer_json) and len(self.newline) == 1
        self.first: dict[str, bytes] = {"": b""}
        # After a space: units without white space at their ends, and the others, which a text may end with.
        self.spaced: dict[str, bytes] = {}
        self.edged: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, memo: dict[str, bytes], units: set[str], before: str) -> None:
        new = units.difference(memo)
        # A word of Latin letters is one piece: its bytes, as the model spells them, go to the model at once.
        words = [u for u in new if u.isalpha() and (u.isascii() or max(u) < AFTER_LATIN)]
        tokenize, space = self.model.tokenize, SPELLED[32] * len(before)
        for word in words:
            spelled = word if word.isascii() else word.encode().decode("latin-1").translate(SPELLED)
            memo[word] = array("I", [token.id for token in tokenize(space + spelled)]).tobytes()
        new = list(new.difference(words))
        lines = [u for u in new if u and "\n" not in u] if len(self.newline) == 1 else []
        for start in range(0, len(lines), LINES):
            part = lines[start:start + LINES]
            ids = self._ids(["\n".join(before + u for u in part)])[0]
            ends = np.r_[np.flatnonzero(ids == self.newline[0]), len(ids)]
            if len(ends) != len(part):  # a unit holds the newline's id in another way
                memo.update(zip(part, (x.tobytes() for x in self._ids([before + u for u in part])), strict=True))
                continue
            raw, at = ids.tobytes(), 0
            for unit, end in zip(part, (4 * ends).tolist(), strict=True):
                memo[unit] = raw[at:end]
                at = end + 4
        rest = [u for u in new if u not in memo]
        memo.update(zip(rest, (x.tobytes() for x in self._ids([before + u for u in rest])), strict=True))

    def _learn_tails(self, new: set[str]) -> None:
        """Units without white space at their ends, as they are after a space.

        The pattern also ends a piece between a word and the marks that close it, and around a newline between visible characters, so a word is encoded
        once for all its endings and whatever line follows.
        """
        lines = {u: parts for u in new if "\n" in u and not any(map(beside_space, parts := u.split("\n")))}
        new = (new - lines.keys()).union(p[0] for p in lines.values()).difference(self.spaced)
        words = {u: word for u in new if (word := u.rstrip(MARKS)) != u and word and word[-1].isalnum()}
        self._learn(self.first, {u[len(word):] for u, word in words.items()}.union(*(p[1:] for p in lines.values())), "")
        self._learn(self.spaced, (new - words.keys()).union(words.values()), " ")
        self.spaced.update([(u, self.spaced[word] + self.first[u[len(word):]]) for u, word in words.items()])
        newline = np.array(self.newline, np.uint32).tobytes()
        self.spaced.update([(u, newline.join((self.spaced[p[0]], *map(self.first.__getitem__, p[1:])))) for u, p in lines.items()])

    def _encode_edged(self, texts: list[str]) -> list[np.ndarray]:
        """Texts with white space beside a space, which is no cut."""
        units = [LONE_SPACE.split(t) for t in texts]
        heads = [u.pop(0) for u in units]
        tails = set().union(*units).difference(self.spaced)
        edged = {u for u in tails if beside_space(u)}
        self._learn(self.first, set(heads), "")
        self._learn(self.edged, edged, " ")
        self._learn_tails(tails - edged)
        return [np.frombuffer(self.first[head] + b"".join(self.edged[u] if u in edged else self.spaced[u] for u in tail), np.uint32)
                for head, tail in zip(heads, units, strict=True)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids (uint32) of each text."""
        if not self.cuts:
            return self._ids(texts)
        if not texts:
            return []
        if len(self.spaced) + len(self.first) + len(self.edged) > MEMO_UNITS:
            self.first, self.spaced, self.edged = {"": b""}, {}, {}
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        begin = split.offsets.to_numpy()
        found = split.flatten().dictionary_encode()
        codes = found.indices.to_numpy().astype(np.int64)
        flat, size, plain = self._plain(found.dictionary)
        others = np.flatnonzero(~plain)
        units = found.dictionary.take(pa.array(others)).to_pylist()
        strange = np.zeros(len(plain), bool)
        strange[others] = [beside_space(u) for u in units]
        odd = np.logical_or.reduceat(strange[codes], begin[:-1])
        if odd.any():
            out: list = [None] * len(texts)
            for some, encode in ((np.flatnonzero(odd), self._encode_edged), (np.flatnonzero(~odd), self.encode)):
                for i, ids in zip(some.tolist(), encode([texts[i] for i in some.tolist()]), strict=True):
                    out[i] = ids
            return out
        heads = found.dictionary.take(pa.array(codes[begin[:-1]])).to_pylist()
        self._learn(self.first, set(heads), "")
        self._learn_tails(set(units).difference(self.spaced))
        # Other units and first ones, which no space comes before, are entries of their own.
        more = [*map(self.spaced.__getitem__, units), *map(self.first.__getitem__, heads)]
        own = np.arange(len(plain))
        own[others] = len(plain) + np.arange(len(others))
        codes = own[codes]
        codes[begin[:-1]] = len(plain) + len(others) + np.arange(len(heads))
        ids, ends = laid_out(np.r_[flat, np.frombuffer(b"".join(more), np.uint32)], np.r_[size, _sizes(more)], codes)
        return np.split(ids, ends[begin[1:-1] - 1])

    def _plain(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, number of ids of each unit, which units these are) for units after a space that consist of words closed by marks, one a line.

        The rule is that of ``_learn_tails``, by columns, for words that begin with a visible character below U+0800 and end with a letter or digit
        below U+0100; units with other words have no ids here.
        """
        lines = pc.split_pattern(units, "\n")
        line, begin = lines.flatten(), lines.offsets.to_numpy()
        words = pc.ascii_rtrim(line, characters=MARKS)
        ends_plainly = _plain_ends(words)
        plain = np.logical_and.reduceat(ends_plainly, begin[:-1])
        of_unit = np.repeat(np.arange(len(units)), np.diff(begin))
        taken = np.flatnonzero(plain[of_unit])
        line, words, of_unit = line.take(pa.array(taken)), words.take(pa.array(taken)), of_unit[taken]
        leads = np.r_[True, of_unit[1:] != of_unit[:-1]][:len(of_unit)]
        marked = np.flatnonzero((pc.binary_length(line).to_numpy() != pc.binary_length(words).to_numpy()))
        marks = pc.replace_substring_regex(line.take(pa.array(marked)), pattern=NOT_CLOSING, replacement="").dictionary_encode()
        pieces = [b"", np.array(self.newline, np.uint32).tobytes()]
        parts = np.zeros((len(taken), 3), np.int64)  # newline, word, marks of each line
        parts[~leads, 0] = 1
        for rows, memo, before in ((np.flatnonzero(leads), self.spaced, " "), (np.flatnonzero(~leads), self.first, "")):
            distinct = words.take(pa.array(rows)).dictionary_encode()
            parts[rows, 1] = len(pieces) + distinct.indices.to_numpy()
            pieces += self._pieces(memo, distinct.dictionary.to_pylist(), before)
        parts[marked, 2] = len(pieces) + marks.indices.to_numpy()
        pieces += self._pieces(self.first, marks.dictionary.to_pylist(), "")
        ids, ends = laid_out(np.frombuffer(b"".join(pieces), np.uint32), _sizes(pieces), parts.ravel())
        size = np.zeros(len(units), np.int64)
        last = np.flatnonzero(np.r_[leads[1:], True][:len(leads)])
        size[plain] = np.diff(ends[3 * last + 2], prepend=0)
        return ids, size, plain

    def _pieces(self, memo: dict[str, bytes], units: list[str], before: str) -> list[bytes]:
        found = [memo.get(u) for u in units]
        new = [i for i, known in enumerate(found) if known is None]
        self._learn(memo, {units[i] for i in new}, before)
        for i in new:
            found[i] = memo[units[i]]
        return found


def _sizes(pieces: list[bytes]) -> np.ndarray:
    return np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4


def laid_out(flat: np.ndarray, size: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces ``codes`` in a row, of pieces that lie in ``flat`` one after another, and where each ends."""
    length = size[codes]
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat((np.cumsum(size) - size)[codes] - (ends - length), length) + np.arange(total)], ends


def _plain_ends(words: pa.Array) -> np.ndarray:
    """Which words begin with a visible character below U+0800 and end with a letter or digit below U+0100, ª, º and superscripts apart."""
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    raw = words.buffers()[2]
    data = np.r_[np.zeros(1, np.uint8), np.frombuffer(raw, np.uint8) if raw else np.zeros(0, np.uint8)]  # a byte before the first
    begin, end = ends[:-1] + 1, ends[1:]
    some = end >= begin
    first, last = data[np.minimum(begin, len(data) - 1)], data[end]
    accented = (data[np.maximum(end - 1, 0)] == 0xC3) & (last >= 0x80) & (last < 0xC0) & (last != 0x97) & (last != 0xB7)
    return some & BEGINS[first] & (ENDS[last] | accented)


def worker_encoder(tokenizer_json: str) -> Encoder:
    """One encoder per Python worker, which serves many tasks: units known from one are not encoded again in the next."""
    kept = sys.modules.setdefault("marmita_encoders", types.ModuleType("marmita_encoders"))
    if tokenizer_json not in vars(kept):
        setattr(kept, tokenizer_json, Encoder(tokenizer_json))
    return getattr(kept, tokenizer_json)


def frequent_pairs(symbols: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, at, which, overlapping) of the symbols at ``at`` (ascending) and their right neighbours: the pairs that occur at least
    ``LEAST`` times without overlap, most frequent first, where they occur, which pair stands there, and further places that overlap those.

    A slot counts one pair, that of one of its places; the few other pairs of crowded slots are sorted.  So all counts are exact.
    """
    left, right, bits = symbols[at], symbols[at + 1], min(SLOT_BITS, 4 + len(at).bit_length())
    slot = (((left * np.uint32(2654435761)) ^ (right * np.uint32(2246822519))) >> np.uint32(32 - bits)).astype(np.intp)
    short = int(symbols.max()) < 1 << 16
    kind, half = (np.uint32, np.uint32(16)) if short else (np.uint64, np.uint64(32))
    pairs = left.astype(kind)
    pairs <<= half
    pairs |= right
    # Only a pair of equal symbols overlaps itself: of a run take the first, third, ... occurrence.
    equal = np.flatnonzero(left == right)
    place = np.arange(len(equal))
    begin = np.maximum.accumulate(np.where(np.r_[True, np.diff(at[equal]) > 1][:len(equal)], place, 0))
    overlap = equal[(place - begin) % 2 == 1]
    of_slot = np.zeros(1 << bits, kind)
    of_slot[slot] = pairs
    others = np.flatnonzero(of_slot[slot] != pairs)
    known, number = np.unique(pairs[others], return_inverse=True)
    slot[others] = len(of_slot) + number
    times = np.bincount(slot, minlength=len(of_slot) + len(known))
    np.subtract.at(times, slot[overlap], 1)
    often = np.flatnonzero(times >= LEAST)
    pairs = np.r_[of_slot, known][often].astype(np.uint64)
    pairs = pairs >> np.uint64(half) << np.uint64(32) | pairs & np.uint64((1 << int(half)) - 1)
    order = np.lexsort((pairs, -times[often]))
    rank = np.full(len(times), -1, np.int32)
    rank[often[order]] = np.arange(len(order))
    rank = rank[slot]
    frequent = rank >= 0
    rest = at[overlap[frequent[overlap]]]
    frequent[overlap] = False
    frequent = np.flatnonzero(frequent)
    return pairs[order], at[frequent], rank[frequent], rest


def repair(ids: np.ndarray, starts: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, first symbol of each document, rules) of the concatenated ``ids`` of documents that begin at ``starts``.

    A round replaces every frequent pair where no more frequent one overlaps it; rounds go on until no pair is frequent.  All
    occurrences of the most frequent pair are replaced, so each round shortens the symbols.  Pairs get rarer unless a symbol of theirs was put in, so after
    the first round only places of pairs that were frequent, or that touch what the last round put in, are counted.
    """
    symbols, starts, rules = ids.astype(np.uint32), starts.astype(np.int64), {}
    inner = np.ones(max(0, len(symbols) - 1), bool)
    inner[[i - 1 for i in starts.tolist() if 0 < i < len(symbols)]] = False
    count = np.flatnonzero(inner)
    while len(count):
        pairs, at, which, overlapping = frequent_pairs(symbols, count)
        if not len(at):
            break
        near, rise = np.diff(at) == 1, np.diff(which)
        first = np.flatnonzero(np.r_[True, ~near | (rise < 0)] & np.r_[~near | (rise > 0), True])
        chosen = which[first]
        # The others of a pair that loses too many places wait for a later round.
        used = np.bincount(chosen, minlength=len(pairs)) >= LEAST
        number, known = np.zeros(len(pairs), np.uint32), len(rules)
        for i, pair in zip(np.flatnonzero(used).tolist(), pairs[used].tolist(), strict=True):
            number[i] = rules.setdefault(pair, base + len(rules))
        placed = np.flatnonzero(used[chosen])
        put = at[first[placed]]
        symbols[put] = number[chosen[placed]]
        n, symbols = len(symbols), np.delete(symbols, put + 1)
        starts = starts - np.searchsorted(put, starts - 1)
        touched = np.zeros(n + 1, bool)
        touched[at] = touched[overlapping] = touched[put - 1] = True  # -1 is the entry behind the last symbol
        touched = np.delete(touched, put + 1)
        if (again := number[used & (number < base + known)]).size:  # symbols of former rounds, which stand elsewhere too
            same = np.flatnonzero(np.isin(symbols, again))
            touched[same] = touched[same - 1] = True
        touched[len(symbols) - 1:] = False
        touched[starts[starts > 0] - 1] = False
        count = np.flatnonzero(touched)
    return symbols, starts, np.array([(p >> 32, p & 0xFFFFFFFF) for p in rules], np.uint32).reshape(-1, 2)


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    lengths = np.ones(len(rules), np.int64)
    for i, (a, b) in enumerate(rules.tolist()):
        lengths[i] = sum(lengths[x - base] if x >= base else 1 for x in (a, b))
    return lengths


def _written(shard: int, number: int, doc_ids: list, parts: list[np.ndarray], base: int) -> pa.RecordBatch:
    lengths = np.array([len(p) for p in parts], np.int64)
    starts = np.r_[0, np.cumsum(lengths)]
    symbols, offsets, rules = repair(np.concatenate(parts), starts, base)
    width = 2 if base + len(rules) <= 1 << 16 else 4
    return pa.RecordBatch.from_arrays(
        [pa.array([shard], pa.int64()), pa.array([number], pa.int64()), pa.array([int(lengths.sum())], pa.int64()),
         pa.array([doc_ids], pa.list_(pa.int64())),
         pa.array([base], pa.int64()), pa.array([width], pa.int32()),
         *(pa.array([x], pa.binary()) for x in (
             offsets.astype("<u4").tobytes(), lengths.astype("<u4").tobytes(), rules.astype("<u4").tobytes(),
             expansion_lengths(rules, base).astype("<u4").tobytes(), symbols.astype(f"<u{width}").tobytes()))],
        ["shard", "block", "n_tokens", "doc_ids", "base", "width", "offsets", "lengths", "rules", "expansions", "symbols"])


def _encode(tokenizer_json: str, end_id: int):
    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = worker_encoder(tokenizer_json)
        base = max(encoder.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
        shard, number = TaskContext.get().partitionId(), 0
        doc_ids, parts, size = [], [], 0
        end = np.array([end_id], np.uint32)
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
            start = 0
            while start < len(texts):
                stop, chars = start, 0
                while stop < len(texts) and (stop == start or chars + len(texts[stop]) <= ENCODED_TOGETHER):
                    chars += len(texts[stop])
                    stop += 1
                for doc_id, encoded in zip(ids[start:stop], encoder.encode(texts[start:stop]), strict=True):
                    if size and size + len(encoded) >= BLOCK_TOKENS:
                        yield _written(shard, number, doc_ids, parts, base)
                        doc_ids, parts, size, number = [], [], 0, number + 1
                    doc_ids.append(doc_id)
                    parts += [np.concatenate([encoded, end])]
                    size += len(encoded) + 1
                start = stop
        if parts:
            yield _written(shard, number, doc_ids, parts, base)
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer_json: str, end_id: int = 2) -> None:
    """The ids of every text of ``docs`` (doc_id, text), each followed by ``end_id``, as blocks below ``path``.

    Documents go by doc_id, null first, repeated ids by their texts; null texts are empty.  A text of any length is one document; a block
    then holds it alone.  No rows give a folder without blocks; other columns are ignored.
    """
    tie = F.xxhash64("text")
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
               .withColumn("tie", tie).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text"))
    ordered.select("doc_id", "text").mapInArrow(_encode(tokenizer_json, end_id), BLOCKS).write.parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(path)


def expansions(rules: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all rules' symbols in a row, and where each begins."""
    out: list[list[int]] = []
    for a, b in rules.tolist():
        out.append((out[a - base] if a >= base else [a]) + (out[b - base] if b >= base else [b]))
    lengths = np.array([len(x) for x in out], np.int64)
    return np.array([t for x in out for t in x], np.uint32), np.r_[0, np.cumsum(lengths)]


def decoded(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """Tokens of a run of symbols."""
    flat, begin = expansions(rules, base)
    table = np.concatenate([np.arange(base, dtype=np.uint32), flat])
    plain = symbols < base
    rule = np.where(plain, 0, symbols.astype(np.int64) - base)
    source = np.where(plain, symbols, base + begin[rule])
    length = np.where(plain, 1, np.diff(begin)[rule] if len(rules) else 1)
    shift = source - (np.cumsum(length) - length)
    return table[np.repeat(shift, length) + np.arange(int(length.sum()))]


def unpacked(block: dict) -> tuple[np.ndarray, ...]:
    """(symbols, offsets, lengths, rules, expansion lengths) of a block's row."""
    offsets, lengths, expanded = (np.frombuffer(block[c], "<u4").astype(np.int64) for c in ("offsets", "lengths", "expansions"))
    return (np.frombuffer(block["symbols"], f"<u{block['width']}").astype(np.uint32), offsets, lengths,
            np.frombuffer(block["rules"], "<u4").reshape(-1, 2), expanded)


def tokens_of(block: dict, document: int, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Tokens [start, stop) of one document of a block; symbols outside of them are skipped by their expansion lengths."""
    symbols, offsets, lengths, rules, expanded = unpacked(block)
    base = block["base"]
    own = symbols[offsets[document]:offsets[document + 1]]
    stop = int(lengths[document]) if stop is None else min(stop, int(lengths[document]))
    sizes = np.r_[np.ones(base, np.int64), expanded][own]
    ends = np.cumsum(sizes)
    first, last = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
    if start >= stop:
        return np.zeros(0, np.uint32)
    skipped = int(ends[first] - sizes[first])
    return decoded(own[first:last], rules, base)[start - skipped:stop - skipped]


def _summaries(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            block = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
            symbols, _, lengths, rules, _ = unpacked(block)
            tokens = decoded(symbols, rules, block["base"]).astype("<u4")
            ends = np.cumsum(lengths)
            n = len(lengths)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block["shard"]] * n, pa.int64()), pa.array([block["block"]] * n, pa.int64()),
                 pa.array(block["doc_ids"], pa.int64()), pa.array(ends - lengths, pa.int64()), pa.array(lengths, pa.int64()),
                 pa.array([zlib.crc32(tokens[e - k:e].tobytes()) for e, k in zip(ends.tolist(), lengths.tolist(), strict=True)], pa.int64())],
                ["shard", "block", "doc_id", "at", "n_tokens", "ids_crc32"])


def documents_of(blocks: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files; start counts the tokens of all documents before."""
    per_block = blocks.select("shard", "block", F.col("n_tokens").alias("n"))
    per_shard = per_block.groupBy("shard").agg(F.sum("n").alias("n_shard"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    shards = per_shard.select("shard", F.coalesce(F.sum("n_shard").over(before), F.lit(0)).alias("shard_start"))
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = per_block.select("shard", "block", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("block_start")).join(shards, "shard")
    read = blocks.mapInArrow(_summaries, "shard long, block long, doc_id long, at long, n_tokens long, ids_crc32 long")
    return read.join(begins, ["shard", "block"]).select(
        "doc_id", (F.col("shard_start") + F.col("block_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
