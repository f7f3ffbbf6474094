import random
import re
import unicodedata
from collections import defaultdict
from itertools import combinations_with_replacement

import numpy as np
import zlib
from tokenizers import Tokenizer

from sievework.llm import packing
from tests.llm.cases import empty, rows, table


def check(found, data, window):
    tokenizer = Tokenizer.from_file(packing.default_path())
    wanted = defaultdict(list)
    for r in data:
        wanted[r[0]].append(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1])
    sequences = defaultdict(list)
    got = defaultdict(int)
    for p in found:
        ids = next(x for x in wanted[p.doc_id] if len(x) == p.doc_tokens)
        assert zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes()) == p.ids_crc32
        sequences[p.sequence_id].append((p.offset, p.length))
        for k in range(p.start, p.start + p.length):
            got[p.doc_id, p.doc_tokens, k] += 1
    need = defaultdict(int)
    for d, many in wanted.items():
        for ids in many:
            for k in range(len(ids)):
                need[d, len(ids), k] += 1
    assert got == need
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window
        padding += window - at
    assert padding < window


def test_round_trip(spark):
    data = rows(60)
    check(packing.query(table(spark, data)).collect(), data, 2048)


def test_small_window_uses_combinations(spark):
    data = rows(120, seed=4)
    check(packing.pieces(table(spark, data), packing.default_path(), 128).collect(), data, 128)


def test_encoder_agrees_with_the_tokenizer():
    encoder = packing.Encoder(packing.default_path())
    texts = ["", "It's 100% don't stop x", "ΣΟΣ Σ", "été İstanbul", "a\x1cb <|endoftext|> c", "ab!!cd ...x_y", "a|b | || |, x|. c|", " ".join(f"w{k}q{k * k}, z{k}." for k in range(250)), "\U0001f600漢字 ẞ"]
    texts += ["dont d s ll ve " + " ".join(a + b for a in "etaoinsr" for b in ("ing", "tion's", "ly.", "né", "2d", "ness")), "lowercase UPPERCASE MixedCase naïve coöperate d'accord", "e\u0301te\u0301 o\u0308l", "a" * 5000]
    texts += [" ".join(w + t for w in ("naïve", "onering", "don't", "x2", "2x", "привет", "漢字") for t in (".", ",", "***", ".&&&", "!?", "'.", ".'", "%%%,", "|.", "-", "\u2026", "\u2014.", "1.", "'s.")), "... , *** - ' '' .' '. |", "ǆ ǅ Ǆ ŉ ﬁ ª º ᾳ ᾼ"]
    for text, ids in zip(texts, encoder.ids(texts), strict=True):
        assert ids.tolist() == [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 1]


def plain_combinations(lengths, window):
    out = set()
    for n in (2, 3):
        out |= {c for c in combinations_with_replacement(sorted(lengths), n) if sum(c) == window}
    out |= {tuple(sorted((a, a, a, b))) for a in lengths for b in lengths if 3 * a + b == window}
    return out | {tuple(sorted((a, a, b, b))) for a in lengths for b in lengths if 2 * (a + b) == window}


def test_combinations_are_all():
    lengths = [3, 5, 16, 21, 22, 32, 40, 43, 56, 59, 60, 64, 80, 88, 123, 125]
    found = packing.combinations(np.array(lengths), 128)
    found = [tuple(v for v in row if v) for row in found.tolist()]
    assert sorted(found) == sorted(plain_combinations(lengths, 128))
    assert len(packing.combinations(np.array([], int), 128)) == 0


def slots(counts, window):
    """The rows of each sequence, by the plan's slots alone."""
    places, used, ways = packing.plan(counts, window)
    found = defaultdict(list)
    stream = 0
    for a, n in counts.items():
        ranks, where = places[a]
        assert ranks == sorted(ranks) and ranks[0] == 0 and where[-1][0] is None
        for low, high, (seq, offset) in zip(ranks, [*ranks[1:], n], where, strict=True):
            for r in range(low, high):
                if seq is None:
                    stream += 1
                else:
                    found[seq + r - low].append((offset, a))
    for parts in found.values():
        at = 0
        for offset, a in sorted(parts):
            assert offset == at
            at += a
        assert at == window
    assert sorted(found) == list(range(used)) and stream == ways["stream"] and sum(ways.values()) == sum(counts.values())
    return ways


def test_plan_fills_windows():
    assert slots({100: 50, 28: 50, 64: 30, 127: 3}, 128) == {"least_squares": 130, "greedy": 0, "stream": 3}
    assert slots({16: 8, 90: 1, 10: 3, 8: 1}, 128) == {"least_squares": 0, "greedy": 13, "stream": 0}
    assert slots({127: 5}, 128) == {"least_squares": 0, "greedy": 0, "stream": 5}
    assert slots({}, 128) == {"least_squares": 0, "greedy": 0, "stream": 0}


def test_least_squares_place_most_rows():
    rng = np.random.default_rng(5)
    lengths, n = np.unique(np.clip(rng.normal(900, 450, 20_000).astype(int), 1, 2047), return_counts=True)
    ways = slots(dict(zip(lengths.tolist(), n.tolist(), strict=True)), 2048)
    assert ways["least_squares"] > 0.9 * n.sum() and ways["stream"] < 0.1 * n.sum()


def test_empty(spark):
    assert packing.query(empty(spark)).count() == 0


def test_marks_after_letters_are_words_of_their_own():
    encoder = packing.Encoder(packing.default_path())
    assert encoder.words("One, two_three... don't 4.5% été!|") == ["one", ",", "two", "_three", "...", "don't", "4", ".5", "%", "été", "!|"]
    assert len(encoder.known) == 0 and encoder.ids(["stone. stone, stone"]) and set(encoder.known) == {"stone", ".", ","}
    rng = random.Random(5)
    signs = "ab é ß ² ½ 7 ǅ ا _ ' . , ! - | $ %* \t \n 漢 ʰ's ' ʼ".split(" ") + [" "] * 6
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(3000)]
    for t, ids in zip(texts, encoder.ids(texts), strict=True):
        assert ids.tolist() == [*encoder.tokenizer.encode(t, add_special_tokens=False).ids, 1], t


def test_what_stands_before_a_mark_is_a_letter_or_a_number():
    letters = re.compile(r"[^\W_]")
    assert all(unicodedata.category(chr(c))[0] in "LN" for c in range(0x110000) if letters.match(chr(c)))
