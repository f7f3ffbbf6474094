import hashlib
import random
import zlib

import numpy as np
import pytest

from sievework.llm import media, webp
from tests.llm.cases import empty, rows, table


def test_rows(spark):
    data = rows()
    out = media.stored_rows(table(spark, data), keep_file=True).collect()
    assert len(out) == len(data)
    by_text: dict = {}
    for r in out:
        payload = b"".join(f[:, :, 1].tobytes() for f in webp.decode(r.media))
        text = payload[: r.n_bytes]
        assert len(payload) == r.payload_bytes and payload[r.n_bytes :] == b"\xff" * (len(payload) - r.n_bytes)
        assert r.payload_bytes % 576 == 0 and r.payload_bytes - max(r.n_bytes, 1) < 576
        assert hashlib.sha256(payload).hexdigest() == r.payload_sha256 and zlib.crc32(payload[-32:]) == r.tail_crc32
        assert hashlib.sha256(r.media).hexdigest() == r.media_sha256 and len(r.media) == r.media_bytes
        assert by_text.setdefault(text, r[1:]) == r[1:]
    assert sorted(by_text) == sorted({(r[1] or "").encode() for r in data})
    assert media.query(empty(spark)).count() == 0


def test_every_padding_and_many_frames():
    rng = random.Random(4)
    texts = [bytes(rng.choices(range(97, 123), k=n)) for n in (0, 1, 570, 571, 572, 573, 574, 575, 576, 577, 4607, 4608, 4609, 20_000)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    filled, edges = media.padded(data, np.cumsum([0, *map(len, texts)]))
    files = webp.encode_planes(filled, edges)
    for f, plane, text in zip(files, webp.decode_planes(files), texts, strict=True):
        assert plane.tobytes()[: len(text)] == text
        assert plane.tobytes() == b"".join(x[:, :, 1].tobytes() for x in webp.decode(f))


def test_matches_are_repeats_of_their_own_frame():
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdef", k=rng.randint(2, 9))) for _ in range(30)]
    texts = [" ".join(rng.choices(words, k=n)).encode() for n in (0, 5, 200, 3000)] + [b"a" * 9000, b"ab" * 300, bytes(range(256)) * 40]
    data = np.frombuffer(b"".join(texts), np.uint8)
    filled, edges = media.padded(data, np.cumsum([0, *map(len, texts)]))
    frame = np.concatenate([first * 1000 + np.arange(n) // (webp.WIDTH * webp.ROWS) for first, n in enumerate(np.diff(edges))])
    frame = np.unique(frame, return_inverse=True)[1]
    at, length, back = webp.matches(filled, frame)
    assert (at[1:] >= (at + length)[:-1]).all() and length.min() >= webp.LEAST and length.max() == webp.LONGEST
    assert len(set(back.tolist())) > 100
    for i, n, d in zip(at.tolist(), length.tolist(), back.tolist(), strict=True):
        assert frame[i - d] == frame[i + n - 1] and all(filled[i + k] == filled[i + k - d] for k in range(n))
    files = webp.encode_planes(filled, edges)
    assert [p.tobytes() for p in webp.decode_planes(files)] == [filled[i:j].tobytes() for i, j in zip(edges, edges[1:])]
    assert all(webp.plain_head(s) for f in files for s in webp.streams(f))
    assert files[3] == webp.encode_planes(filled[edges[3] : edges[4]], np.array([0, edges[4] - edges[3]]))[0]


@pytest.mark.parametrize("value", [1, 2, 3, 4, 5, 6, 7, 8, 9, 127, 128, 129, 4096, 4728])
def test_symbols_of_many_values(value):
    assert [int(x[0]) for x in webp.symbols_for(np.array([value]))] == list(webp.symbol_for(value))


def prefix(w: webp.Writer, lengths: dict[int, int], size: int) -> dict:
    """Writes a code; its symbols' bits."""
    if len(lengths) == 1:
        w.put(0b101 | min(lengths) << 3, 11)
        return {min(lengths): (0, 0)}
    w.put(0, 1)
    w.put(15, 4)
    for s in webp.LENGTH_ORDER:
        w.put(4 if s < 16 else 0, 3)
    w.put(0, 1)
    own = [lengths.get(s, 0) for s in range(size)]
    for n in own:
        w.put(webp.turned(n, 4), 4)
    return webp.canonical(own)


def image(w: webp.Writer, pixels: list[int], width: int, main: bool, cache: int = 0, copies: bool = False) -> None:
    """An entropy-coded image: literals, cache hits and copies of what stands `width` before."""
    w.put(1 if cache else 0, 1)
    if cache:
        w.put(cache, 4)
    if main:
        w.put(0, 1)
    symbols, table, at = [], {}, 0
    code = lambda p: (0x1E35A7BD * p & 0xFFFFFFFF) >> (32 - cache)
    while at < len(pixels):
        n = 0
        while copies and at >= width and at + n < len(pixels) and pixels[at + n] == pixels[at + n - width]:
            n += 1
        if n >= 2:
            symbols.append(("copy", n))
        elif cache and table.get(code(pixels[at])) == pixels[at]:
            n = symbols.append(("cache", code(pixels[at]))) or 1
        else:
            n = symbols.append(("pixel", pixels[at])) or 1
        for p in pixels[at : at + n]:
            table[code(p) if cache else 0] = p
        at += n
    counts: list[dict] = [{}, {}, {}, {}, {}]
    spelled = []
    for kind, v in symbols:
        if kind == "pixel":
            a, r, g, b = webp.channels(v)
            spelled.append([(0, g), (1, r), (2, b), (3, a)])
        elif kind == "cache":
            spelled.append([(0, 280 + v)])
        else:
            s, extra, more = webp.symbol_for(v)
            t, far, bits = webp.symbol_for(1)  # distance code 1: the pixel above
            spelled.append([(0, 256 + s), (extra, more), (4, t), (far, bits)])
        for k, s in (x for i, x in enumerate(spelled[-1]) if kind != "copy" or i % 2 == 0):
            counts[k][s] = counts[k].get(s, 0) + 1
    sizes = (280 + (1 << cache if cache else 0), 256, 256, 256, 40)
    codes = [prefix(w, webp.code_lengths(c or {0: 1}), n) for c, n in zip(counts, sizes, strict=True)]
    for parts in spelled:
        copy = parts[0][1] in range(256, 280)
        for i, (k, s) in enumerate(parts):
            w.put(*((k, s) if copy and i % 2 else codes[k][s]))


def stream(width: int, height: int, steps: list, pixels: list[int], across: int, **options) -> bytes:
    w = webp.Writer()
    w.put(webp.SIGNATURE, 8)
    w.put(width - 1, 14)
    w.put(height - 1, 14)
    w.put(1, 4)
    for kind, info, block, block_width in steps:
        w.put(1 | kind << 1, 3)
        if info is not None:
            w.put(info, 8 if kind == webp.PALETTE else 3)
            image(w, block, block_width, False)
    w.put(0, 1)
    image(w, pixels, across, True, **options)
    return w.value.to_bytes((w.n + 7) // 8, "little")


def picture(width: int, height: int, colours: int = 1 << 20) -> list[int]:
    rng = random.Random(width * height)
    palette = [rng.getrandbits(32) for _ in range(min(colours, 40))]
    return [rng.choice(palette) for _ in range(width)] + [rng.choice(palette) if rng.random() < 0.3 else palette[k % len(palette)] for k in range(width * (height - 1))]


def pixels_of(out: np.ndarray) -> list[int]:
    return [int(a) << 24 | int(r) << 16 | int(g) << 8 | int(b) for r, g, b, a in out.reshape(-1, 4)]


def minus(p: int, q: int) -> int:
    return webp.joined((x - y) & 255 for x, y in zip(webp.channels(p), webp.channels(q), strict=True))


@pytest.mark.parametrize("cache", [0, 3])
@pytest.mark.parametrize("copies", [False, True])
def test_literals_cache_and_copies(cache, copies):
    want = picture(13, 9)
    want[39:78] = want[26:65]
    assert pixels_of(webp.decode_stream(stream(13, 9, [], want, 13, cache=cache, copies=copies))) == want


@pytest.mark.parametrize("mode", range(14))
def test_predictors(mode):
    width, height = 9, 8
    want = picture(width, height)
    rest = []
    for at, p in enumerate(want):
        y, x = divmod(at, width)
        if not at:
            guess = webp.BLACK
        elif not y:
            guess = want[at - 1]
        elif not x:
            guess = want[at - width]
        else:
            guess = webp.predicted(mode, want[at - 1], want[at - width], want[at - width - 1], want[at - width + 1])
        rest.append(minus(p, guess))
    block = [webp.BLACK | mode << 8] * 6
    assert pixels_of(webp.decode_stream(stream(width, height, [(webp.PREDICTOR, 0, block, 3)], rest, width))) == want


def test_predictor_values():
    c = lambda *v: webp.joined(v)
    left, top, corner, right = c(255, 10, 20, 30), c(255, 50, 60, 70), c(255, 10, 20, 30), c(255, 90, 100, 111)
    wanted = {0: webp.BLACK, 1: left, 2: top, 3: right, 4: corner, 5: c(255, 50, 60, 70), 6: left, 7: c(255, 30, 40, 50), 8: c(255, 30, 40, 50), 9: c(255, 70, 80, 90), 11: top, 12: top, 13: c(255, 40, 50, 60)}
    for mode, value in wanted.items():
        assert webp.predicted(mode, left, top, corner, right) == value


def test_cross_colour_and_green():
    want = picture(8, 8)
    to_red, to_blue, red_blue = 0xE0, 0x15, 0x30
    rest = []
    for p in want:
        a, r, g, b = webp.channels(p)
        delta = lambda t, v: webp.signed(t) * webp.signed(v) >> 5
        b = (b - delta(to_blue, g) - delta(red_blue, r)) & 255
        r = (r - delta(to_red, g)) & 255
        rest.append(webp.joined((a, (r - g) & 255, g, (b - g) & 255)))
    block = [webp.joined((255, red_blue, to_blue, to_red))] * 4
    steps = [(webp.CROSS, 0, block, 2), (webp.GREEN, None, None, 0)]
    assert pixels_of(webp.decode_stream(stream(8, 8, steps, rest, 8))) == want


@pytest.mark.parametrize("colours", [1, 2, 3, 16, 17])
def test_palettes(colours):
    width, height = 11, 5
    table = [0xFF000000 + 0x010305 * k for k in range(colours)]
    want = [table[(7 * k + k // 3) % colours] for k in range(width * height)]
    pack = 3 if colours <= 2 else 2 if colours <= 4 else 1 if colours <= 16 else 0
    across = (width + (1 << pack) - 1) >> pack
    packed = [0] * (across * height)
    for k, p in enumerate(want):
        y, x = divmod(k, width)
        packed[y * across + (x >> pack)] |= table.index(p) << (x & ((1 << pack) - 1)) * (8 >> pack) << 8
    deltas = [table[0], *(minus(b, a) for a, b in zip(table, table[1:]))]
    found = webp.decode_stream(stream(width, height, [(webp.PALETTE, colours - 1, deltas, colours)], packed, across))
    assert pixels_of(found) == want
    also = webp.decode_planes([webp.file_of([stream(width, height, [(webp.PALETTE, colours - 1, deltas, colours)], packed, across)], [height])])
    assert also[0].tolist() == [p >> 8 & 255 for p in want]


def test_transforms_are_written_where_they_pay(spark):
    rng = random.Random(12)
    rising = "".join(chr(32 + (3 * k + rng.randrange(2)) % 90) for k in range(9000))
    line = [rng.randrange(40, 120) for _ in range(576)]
    below = "".join(chr(v + (y * 5 + rng.randrange(2)) % 7) for y in range(16) for v in line)
    prose = " ".join(rng.choices(["sieve", "work", "flour", "the", "of"], k=900))
    texts = [rising, below, prose, ""]
    out = {r.doc_id: r for r in media.stored_rows(table(spark, [(k, t, None, None, None) for k, t in enumerate(texts)]), keep_file=True).collect()}
    modes = [{webp.plain_head(s)[5] for s in webp.streams(out[k].media)} for k in range(4)]
    assert modes == [{webp.LEFT}, {webp.TOP}, {0}, {0}]
    for k, t in enumerate(texts):
        frames = webp.decode(out[k].media)
        assert all((f[:, :, c] == f[:, :, 1]).all() for f in frames for c in (0, 2)) and all((f[:, :, 3] == 255).all() for f in frames)
        raw = t.encode() + b"\xff" * (out[k].payload_bytes - len(t))
        assert b"".join(f[:, :, 1].tobytes() for f in frames) == raw and out[k].payload_sha256 == hashlib.sha256(raw).hexdigest()
        filled = np.frombuffer(raw, np.uint8)
        assert len(out[k].media) <= len(webp.written(filled, np.array([0, len(filled)]))[0])
