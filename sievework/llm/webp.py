"""The lossless WebP format, read and written.

`decode` reads any lossless file, still or animated: prefix codes, back-references,
colour cache, entropy images, and the predictor, cross-colour, subtract-green and palette
transforms.  `encode_planes` writes 8-bit samples as one or more grey frames: green is
subtracted from red and blue, and where it makes the file smaller samples are predicted from
those to the left or above.  `decode_planes` reads many such files at once: one pixel of every
frame in a step; what it does not know it leaves to `decode`.

A colour cache is read but never written: in a grey frame a pixel that is spelled out takes
one code, as one from the cache does, so a cache only splits that code's counts.  Nor are
cross-colour (red and blue are zero already) and palettes written.
"""

from __future__ import annotations

import heapq
import struct

import numpy as np

# Fixed values of the format.
LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
SIGNATURE = 0x2F
LITERALS, LENGTHS, DISTANCES = 256, 24, 40
PREDICTOR, CROSS, GREEN, PALETTE = 0, 1, 2, 3
BLACK = 0xFF000000
#: Predictors that are written, and the exponent of their blocks' size: a frame is one line of blocks.
LEFT, TOP, BLOCKS = 1, 2, 9
#: Near distances (x, y) in the order of their codes 1 to 120.
NEARBY = sorted(((x, y) for y in range(8) for x in range(-7, 9) if y or x > 0), key=lambda p: (p[0] ** 2 + p[1] ** 2, -p[1], p[0] < 0))

WIDTH, ROWS = 576, 8
CODE_BITS = 11
#: Matches are found by their first GRAM samples, in BLOCK frames at once, and hold LEAST samples or more.
GRAM, LEAST, LONGEST, BLOCK = 6, 7, 4096, 1024
#: Code lengths 0 to 12 and the run symbols are told by codes of four bits each.
LENGTH_SYMBOLS = (*range(13), 16, 17, 18)


class Bits:
    """Reads bits, the lowest first."""

    def __init__(self, data: bytes, at: int = 0):
        self.value, self.at = int.from_bytes(data, "little"), at

    def take(self, n: int) -> int:
        out = (self.value >> self.at) & ((1 << n) - 1)
        self.at += n
        return out


class Writer:
    def __init__(self):
        self.value = self.n = 0

    def put(self, value: int, n: int) -> None:
        self.value |= value << self.n
        self.n += n


#: The bits of each number below 2 ** 15 in reverse order.
TURNED = sum(((np.arange(1 << 15) >> k & 1) << (14 - k) for k in range(15)), np.zeros(1 << 15, np.int64)).tolist()


def turned(code: int, n: int) -> int:
    return TURNED[code] >> (15 - n)


def canonical(lengths: list[int]) -> dict[int, tuple[int, int]]:
    """For each symbol with a code its bits, in reading order, and their number."""
    out, code, before = {}, 0, 0
    for n, s in sorted((n, s) for s, n in enumerate(lengths) if n):
        code <<= n - before
        out[s] = (turned(code, n), n)
        code, before = code + 1, n
    return out


class Prefix:
    """A prefix code. A code of one symbol takes no bits."""

    def __init__(self, lengths: list[int]):
        self.lengths = lengths
        self.most = max(lengths)
        used = len(lengths) - lengths.count(0)
        self.only = lengths.index(self.most) if used < 2 else None
        self.table: list[tuple[int, int]] = []

    def read(self, bits: Bits) -> int:
        if self.only is not None:
            return self.only
        if not self.table:
            self.table = [(0, 0)] * (1 << self.most)
            for s, (code, n) in canonical(self.lengths).items():
                for k in range(code, 1 << self.most, 1 << n):
                    self.table[k] = (s, n)
        symbol, n = self.table[(bits.value >> bits.at) & ((1 << self.most) - 1)]
        if not n:
            raise ValueError("no such prefix code")
        bits.at += n
        return symbol


def read_prefix(bits: Bits, size: int) -> Prefix:
    lengths = [0] * size
    if bits.take(1):
        two, wide = bits.take(1), bits.take(1)
        lengths[bits.take(8 if wide else 1)] = 1
        if two:
            lengths[bits.take(8)] = 1
        return Prefix(lengths)
    inner = [0] * 19
    for k in range(4 + bits.take(4)):
        inner[LENGTH_ORDER[k]] = bits.take(3)
    inner = Prefix(inner)
    left = 2 + bits.take(2 + 2 * bits.take(3)) if bits.take(1) else size
    at, last = 0, 8
    while at < size and left:
        left -= 1
        s = inner.read(bits)
        if s < 16:
            lengths[at] = s
            at += 1
            last = s or last
        else:
            value, extra, base = {16: (last, 2, 3), 17: (0, 3, 3), 18: (0, 7, 11)}[s]
            for _ in range(base + bits.take(extra)):
                if at < size:
                    lengths[at] = value
                at += 1
    return Prefix(lengths)


def value_of(symbol: int, bits: Bits) -> int:
    """A length or distance: a symbol and extra bits."""
    if symbol < 4:
        return symbol + 1
    extra = (symbol - 2) >> 1
    return ((2 + (symbol & 1)) << extra) + bits.take(extra) + 1


def symbol_for(value: int) -> tuple[int, int, int]:
    """Symbol, extra bits and their number for a length or distance."""
    if value <= 4:
        return value - 1, 0, 0
    n = (value - 1).bit_length() - 1
    second = (value - 1) >> (n - 1) & 1
    return 2 * n + second, (value - 1) & ((1 << (n - 1)) - 1), n - 1


def distance_of(code: int, width: int) -> int:
    if code > len(NEARBY):
        return code - len(NEARBY)
    x, y = NEARBY[code - 1]
    return max(1, y * width + x)


def read_pixels(bits: Bits, width: int, height: int, main: bool) -> list[int]:
    """An entropy-coded image as ARGB numbers."""
    cache_bits = bits.take(4) if bits.take(1) else 0
    groups, block, shift = [0], None, 0
    if main and bits.take(1):
        shift = bits.take(3) + 2
        across = (width + (1 << shift) - 1) >> shift
        block = [p >> 8 & 0xFFFF for p in read_pixels(bits, across, (height + (1 << shift) - 1) >> shift, False)]
        groups = list(range(max(block) + 1))
    cache = [0] * (1 << cache_bits) if cache_bits else []
    sizes = (LITERALS + LENGTHS + len(cache), LITERALS, LITERALS, LITERALS, DISTANCES)
    codes = [[read_prefix(bits, n) for n in sizes] for _ in groups]
    out: list[int] = []
    kept = 0  # how many pixels the cache has seen
    while len(out) < width * height:
        if block is not None:
            y, x = divmod(len(out), width)
            green, red, blue, alpha, far = codes[block[(y >> shift) * across + (x >> shift)]]
        else:
            green, red, blue, alpha, far = codes[0]
        s = green.read(bits)
        if s < LITERALS:
            r, b, a = red.read(bits), blue.read(bits), alpha.read(bits)
            out.append(a << 24 | r << 16 | s << 8 | b)
        elif s < LITERALS + LENGTHS:
            n = value_of(s - LITERALS, bits)
            back = distance_of(value_of(far.read(bits), bits), width)
            if back > len(out):
                raise ValueError("back-reference before the first pixel")
            for _ in range(min(n, width * height - len(out))):
                out.append(out[-back])
        else:
            while kept < len(out):
                cache[(0x1E35A7BD * out[kept] & 0xFFFFFFFF) >> (32 - cache_bits)] = out[kept]
                kept += 1
            out.append(cache[s - LITERALS - LENGTHS])
    return out


def channels(p: int) -> tuple[int, int, int, int]:
    return p >> 24, p >> 16 & 255, p >> 8 & 255, p & 255


def joined(c) -> int:
    a, r, g, b = c
    return a << 24 | r << 16 | g << 8 | b


def plus(p: int, q: int) -> int:
    return joined((x + y) & 255 for x, y in zip(channels(p), channels(q), strict=True))


def half(p: int, q: int) -> int:
    return joined((x + y) >> 1 for x, y in zip(channels(p), channels(q), strict=True))


def clip(x: int) -> int:
    return min(255, max(0, x))


def select(left: int, top: int, corner: int) -> int:
    """Left or top, whichever is nearer to left + top - corner."""
    to_left = sum(abs(t - c) for t, c in zip(channels(top), channels(corner), strict=True))
    to_top = sum(abs(x - c) for x, c in zip(channels(left), channels(corner), strict=True))
    return left if to_left < to_top else top


def predicted(mode: int, left: int, top: int, corner: int, right: int) -> int:
    """Value of a pixel from those to its left, above, above left and above right."""
    match mode:
        case 1:
            return left
        case 2:
            return top
        case 3:
            return right
        case 4:
            return corner
        case 5:
            return half(half(left, right), top)
        case 6:
            return half(left, corner)
        case 7:
            return half(left, top)
        case 8:
            return half(corner, top)
        case 9:
            return half(top, right)
        case 10:
            return half(half(left, corner), half(top, right))
        case 11:
            return select(left, top, corner)
        case 12:
            return joined(clip(x + t - c) for x, t, c in zip(channels(left), channels(top), channels(corner), strict=True))
        case 13:
            return joined(clip(m + int((m - c) / 2)) for m, c in zip(channels(half(left, top)), channels(corner), strict=True))
    return BLACK


def signed(x: int) -> int:
    return x - 256 if x > 127 else x


def undo(kind: int, info: tuple, pixels: list[int], width: int, height: int) -> list[int]:
    """Inverts a transform; pixels has the transformed image, rows of its own width."""
    if kind == GREEN:
        return [joined((a, (r + g) & 255, g, (b + g) & 255)) for a, r, g, b in map(channels, pixels)]
    if kind == PALETTE:
        table, pack = info
        across, per = (width + (1 << pack) - 1) >> pack, 8 >> pack
        out = []
        for y in range(height):
            for x in range(width):
                v = (pixels[y * across + (x >> pack)] >> 8 & 255) >> (x & ((1 << pack) - 1)) * per & ((1 << per) - 1)
                out.append(table[v] if v < len(table) else 0)
        return out
    shift, block = info
    across = (width + (1 << shift) - 1) >> shift
    out = []
    for at, p in enumerate(pixels):
        y, x = divmod(at, width)
        code = block[(y >> shift) * across + (x >> shift)]
        if kind == CROSS:
            a, r, g, b = channels(p)
            _, red_to_blue, green_to_blue, green_to_red = (signed(v) for v in channels(code))
            r = (r + (green_to_red * signed(g) >> 5)) & 255
            b = (b + (green_to_blue * signed(g) >> 5) + (red_to_blue * signed(r) >> 5)) & 255
            out.append(joined((a, r, g, b)))
        elif not at:
            out.append(plus(p, BLACK))
        elif not y:
            out.append(plus(p, out[-1]))
        elif not x:
            out.append(plus(p, out[at - width]))
        else:
            out.append(plus(p, predicted(code >> 8 & 15, out[-1], out[at - width], out[at - width - 1], out[at - width + 1])))
    return out


def decode_stream(data: bytes) -> np.ndarray:
    """An image of (height, width, 4) samples: red, green, blue, alpha."""
    if not data or data[0] != SIGNATURE:
        raise ValueError("not a lossless image")
    bits = Bits(data, 8)
    width, height = bits.take(14) + 1, bits.take(14) + 1
    bits.take(1)
    if bits.take(3):
        raise ValueError("unknown version")
    steps, now = [], width
    while bits.take(1):
        kind = bits.take(2)
        info: tuple = ()
        if kind in (PREDICTOR, CROSS):
            shift = bits.take(3) + 2
            info = (shift, read_pixels(bits, (now + (1 << shift) - 1) >> shift, (height + (1 << shift) - 1) >> shift, False))
        elif kind == PALETTE:
            table = read_pixels(bits, bits.take(8) + 1, 1, False)
            for k in range(1, len(table)):
                table[k] = plus(table[k], table[k - 1])
            pack = 3 if len(table) <= 2 else 2 if len(table) <= 4 else 1 if len(table) <= 16 else 0
            info = (table, pack)
        steps.append((kind, info, now))
        if kind == PALETTE:
            now = (now + (1 << info[1]) - 1) >> info[1]
    pixels = read_pixels(bits, now, height, True)
    for kind, info, across in reversed(steps):
        pixels = undo(kind, info, pixels, across, height)
    return np.array([(p >> 16 & 255, p >> 8 & 255, p & 255, p >> 24) for p in pixels], np.uint8).reshape(height, width, 4)


def streams(data: bytes) -> list[bytes]:
    """The lossless streams of a file, in order."""
    if data[:4] != b"RIFF" or data[8:12] != b"WEBP":
        raise ValueError("not a WebP file")
    out, at, end = [], 12, 8 + int.from_bytes(data[4:8], "little")
    while at + 8 <= end:
        name, size = data[at : at + 4], int.from_bytes(data[at + 4 : at + 8], "little")
        if name == b"ANMF":
            at += 8 + 16  # the frame's own chunks follow
            continue
        if name == b"VP8L":
            out.append(data[at + 8 : at + 8 + size])
        at += 8 + size + size % 2
    return out


def decode(data: bytes) -> list[np.ndarray]:
    """The frames of a file."""
    return [decode_stream(s) for s in streams(data)]


def chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2)


def file_of(frames: list[bytes], heights: list[int], width: int = WIDTH) -> bytes:
    """A still image, or an animation if there are several frames."""
    if len(frames) == 1:
        body = chunk(b"VP8L", frames[0])
    else:
        size = (width - 1).to_bytes(3, "little")
        body = chunk(b"VP8X", b"\x02\0\0\0" + size + (max(heights) - 1).to_bytes(3, "little")) + chunk(b"ANIM", b"\0" * 6)
        for f, h in zip(frames, heights, strict=True):
            body += chunk(b"ANMF", b"\0" * 6 + size + (h - 1).to_bytes(3, "little") + b"\x64\0\0\x02" + chunk(b"VP8L", f))
    return b"RIFF" + struct.pack("<I", 4 + len(body)) + b"WEBP" + body


def code_lengths(counts: dict[int, int], most: int = CODE_BITS) -> dict[int, int]:
    """Lengths of an optimal code for the counts; rare symbols are made less rare until none is longer than most."""
    if len(counts) == 1:
        return dict.fromkeys(counts, 1)
    total, floor = sum(counts.values()), 0
    while True:
        heap = [(max(n, floor), s, (s,)) for s, n in counts.items()]
        heapq.heapify(heap)
        depth = dict.fromkeys(counts, 0)
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            for s in a[2] + b[2]:
                depth[s] += 1
            heapq.heappush(heap, (a[0] + b[0], min(a[1], b[1]), a[2] + b[2]))
        if max(depth.values()) <= most:
            return depth
        floor = max(2 * floor, total >> most, 1)


def put_code(w: Writer, lengths: dict[int, int], size: int) -> None:
    """A prefix code over `size` symbols; one literal or no symbol as the short form."""
    if not lengths or len(lengths) == 1 and min(lengths) < LITERALS:
        w.put(0b101 | min(lengths, default=0) << 3, 11)
        return
    w.put(0, 1)
    w.put(19 - 4, 4)
    for s in LENGTH_ORDER:
        w.put(4 if s in LENGTH_SYMBOLS else 0, 3)
    w.put(0, 1)
    code = {s: turned(k, 4) for k, s in enumerate(LENGTH_SYMBOLS)}
    at = 0
    for s in [*sorted(lengths), size]:
        gap = s - at
        while gap:
            if gap >= 11:
                n = min(gap, 138)
                w.put(code[18], 4)
                w.put(n - 11, 7)
            elif gap >= 3:
                n = gap
                w.put(code[17], 4)
                w.put(n - 3, 3)
            else:
                n = 1
                w.put(code[0], 4)
            gap -= n
        if s < size:
            w.put(code[lengths[s]], 4)
        at = s + 1


def header(height: int, green: dict[int, int], far: dict[int, int], width: int = WIDTH, mode: int = 0) -> tuple[int, int]:
    """Bits before the first pixel, and their number: green subtracted, a predictor if mode says so, no cache, one group of codes."""
    w = Writer()
    w.put(SIGNATURE, 8)
    w.put(width - 1, 14)
    w.put(height - 1, 14)
    w.put(0, 1 + 3)  # alpha, version
    w.put(1 | GREEN << 1, 3)
    if mode:
        w.put(1 | PREDICTOR << 1, 3)
        w.put(BLOCKS - 2, 3)
        w.put(0, 1)  # the blocks' image has no cache
        for only in (mode, 0, 0, 255):
            put_code(w, {only: 1}, LITERALS)
        put_code(w, {}, DISTANCES)
    w.put(0, 1 + 1 + 1)  # no other transform, no cache, no entropy image
    put_code(w, green, LITERALS + LENGTHS)
    for only in (0, 0, 0 if mode else 255):  # red, blue, alpha
        put_code(w, {only: 1}, LITERALS)
    put_code(w, far, DISTANCES)
    return w.value, w.n


def residuals(data: np.ndarray, offsets: np.ndarray, mode: int) -> np.ndarray:
    """What a predictor leaves of each row's frames."""
    x = data.reshape(-1, WIDTH)
    first = offsets[:-1] // WIDTH
    y = (np.arange(len(x)) - np.repeat(first, np.diff(offsets) // WIDTH)) % ROWS
    out = x.copy()
    out[:, 1:] -= x[:, :-1]
    inner = np.flatnonzero(y)
    if mode == LEFT:
        out[inner, 0] -= x[inner - 1, 0]
    else:
        out[inner] = x[inner] - x[inner - 1]
    return out.ravel()


def restore(rest: np.ndarray, width: int, mode: int) -> np.ndarray:
    """A frame's samples from what the predictor left."""
    x = rest.reshape(-1, width).copy()
    if mode == LEFT:
        x[:, 0] = np.cumsum(x[:, 0], dtype=np.uint8)
    else:
        x[0] = np.cumsum(x[0], dtype=np.uint8)
    return np.cumsum(x, axis=1 if mode == LEFT else 0, dtype=np.uint8).ravel()


def entropies(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of each row's samples by their frequencies."""
    rows, size = len(offsets) - 1, np.diff(offsets)
    key = np.repeat(np.arange(rows, dtype=np.int32) << 8, size) | data
    n = np.bincount(key, minlength=rows << 8).reshape(rows, 256)
    return size * np.log2(np.maximum(size, 1)) - (n * np.log2(np.maximum(n, 1))).sum(axis=1)


def matches(data: np.ndarray, frame: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where a frame repeats at least LEAST samples of its own, how many and from how far back; the first that comes is taken.

    Frames are in order.  A sample looks for the nearest place before it with the same GRAM
    samples; the match goes on as long as the samples after it look as far back.
    """
    found: tuple[list, list, list] = ([], [], [])
    if not len(frame):
        return tuple(np.zeros(0, np.int64) for _ in found)
    edges = np.searchsorted(frame, np.arange(0, int(frame[-1]) + 1 + BLOCK, BLOCK))
    for low, high in zip(edges, edges[1:], strict=False):
        x, of = data[low:high], frame[low:high] - frame[low]
        n = len(x) - GRAM + 1
        if n < 2:
            continue
        inside = np.flatnonzero(of[:n] == of[GRAM - 1 :])
        gram = np.zeros(n, np.uint64)
        for k in range(GRAM):
            gram = gram << np.uint64(8) | x[k : k + n]
        # one sort by frame, a hash of the samples, and place
        begin = np.searchsorted(of, np.arange(int(of[-1]) + 1))
        own = of[inside]
        key = own.astype(np.uint64) << np.uint64(54) | gram[inside] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(23) << np.uint64(13) | (inside - begin[own]).astype(np.uint64)
        key.sort()
        at = (key & np.uint64(8191)).astype(np.int64) + begin[(key >> np.uint64(54)).astype(np.int64)]
        later = np.flatnonzero(key[1:] >> np.uint64(13) == key[:-1] >> np.uint64(13))
        here, there = at[later + 1], at[later]
        same = gram[here] == gram[there]
        back = np.zeros(n, np.int32)
        back[here[same]] = (here - there)[same]
        ends = np.r_[np.flatnonzero(back[1:] != back[:-1]), n - 1]
        length = np.minimum(np.repeat(ends, np.diff(np.r_[-1, ends])) - np.arange(n) + GRAM, LONGEST)
        good = (back > 0) & (length >= LEAST)
        places = np.r_[np.flatnonzero(good), n]
        following = memoryview(places[np.cumsum(good) - good].astype(np.int32))
        lengths = memoryview(length.astype(np.int32))
        starts, at = [], 0
        while at < n and (at := following[at]) < n:
            starts.append(at)
            at += lengths[at]
        taken = np.array(starts, np.int64)
        for out, part in zip(found, (taken + low, length[taken], back[taken]), strict=True):
            out.append(part)
    return tuple(np.concatenate(part).astype(np.int64) if part else np.zeros(0, np.int64) for part in found)


def symbols_for(value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """symbol_for of many values."""
    less = value - 1
    n = np.log2(np.maximum(less, 1)).astype(np.int64)
    extra = np.maximum(n - 1, 0)
    symbol = np.where(less < 4, less, 2 * n + (less >> extra & 1))
    extra = np.where(less < 4, 0, extra)
    return symbol, less & ((1 << extra) - 1), extra


def codes_for(row: np.ndarray, symbol: np.ndarray, rows: int, size: int) -> tuple[list[dict[int, int]], np.ndarray, np.ndarray]:
    """Each row's code lengths for its symbols; their bits and widths, (rows, size)."""
    counts = np.bincount(row * size + symbol, minlength=rows * size).reshape(rows, size)
    bits, widths = np.zeros((rows, size), np.int64), np.zeros((rows, size), np.int64)
    lengths = []
    for k in range(rows):
        used = np.flatnonzero(counts[k])
        own = code_lengths(dict(zip(used.tolist(), counts[k, used].tolist(), strict=True))) if len(used) else {}
        lengths.append(own)
        if len(own) > 1:  # a single symbol takes no bits
            for s, (code, n) in canonical([own.get(s, 0) for s in range(size)]).items():
                bits[k, s], widths[k, s] = code, n
    return lengths, bits, widths


def encode_planes(data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """A file for each row of data: WIDTH samples a line, ROWS lines a frame at most.

    A row's length is a multiple of WIDTH.  Predictors that promise fewer bits for a row are
    tried, and the smallest file stays.
    """
    files = written(data, offsets)
    plain = entropies(data, offsets)
    for mode in (LEFT, TOP):
        rest = residuals(data, offsets, mode)
        tried = np.flatnonzero(entropies(rest, offsets) < plain)
        if not len(tried):
            continue
        own = np.concatenate([rest[offsets[k] : offsets[k + 1]] for k in tried])
        for k, file in zip(tried.tolist(), written(own, np.r_[0, np.cumsum(np.diff(offsets)[tried])], mode), strict=True):
            if len(file) < len(files[k]):
                files[k] = file
    return files


def written(data: np.ndarray, offsets: np.ndarray, mode: int = 0) -> list[bytes]:
    """A file for each row of samples, or of what the predictor `mode` leaves of them.

    What a frame repeats of itself is written as back-references; a row's frames share
    their prefix codes.
    """
    rows = len(offsets) - 1
    sizes = np.diff(offsets)
    step = WIDTH * ROWS
    frames = -(-sizes // step)
    first = np.cumsum(frames) - frames
    of = np.repeat(np.arange(rows), frames)
    part = np.arange(len(of)) - first[of]
    lines = np.minimum(ROWS, sizes[of] // WIDTH - part * ROWS)
    frame = np.repeat(np.arange(len(of)), lines * WIDTH)
    at, length, back = matches(data, frame)
    # what is written: a literal, or a match's length symbol, its bits, distance symbol and bits
    parts_of = np.ones(len(data), np.int8)
    change = np.zeros(len(data) + 1, np.int8)
    change[at] += 1
    np.add.at(change, at + length, np.int8(-1))
    parts_of[np.cumsum(change[:-1], dtype=np.int8) > 0] = 0
    parts_of[at] = 4
    literal = np.flatnonzero(parts_of == 1)
    place = np.cumsum(parts_of, dtype=np.int64) - parts_of
    n_symbol, n_bits, n_width = symbols_for(length)
    d_symbol, d_bits, d_width = symbols_for(np.where(back == 1, 2, back + len(NEARBY)))
    l_row, m_row = of[frame[literal]], of[frame[at]]
    green, bits, widths = codes_for(np.r_[l_row, m_row], np.r_[data[literal], LITERALS + n_symbol], rows, LITERALS + LENGTHS)
    far, d_code, d_length = codes_for(m_row, d_symbol, rows, DISTANCES)
    total = int(parts_of.sum(dtype=np.int64))
    value, width, owner = np.zeros(total, np.int64), np.zeros(total, np.int64), np.zeros(total, np.int64)
    value[place[literal]], width[place[literal]] = bits[l_row, data[literal]], widths[l_row, data[literal]]
    owner[place[literal]] = frame[literal]
    written = (
        (bits[m_row, LITERALS + n_symbol], widths[m_row, LITERALS + n_symbol]),
        (n_bits, n_width),
        (d_code[m_row, d_symbol], d_length[m_row, d_symbol]),
        (d_bits, d_width),
    )
    for k, (v, w) in enumerate(written):
        value[place[at] + k], width[place[at] + k], owner[place[at] + k] = v, w, frame[at]
    heads: dict[tuple[int, int], tuple[int, int]] = {}
    for k, h in zip(of.tolist(), lines.tolist(), strict=True):
        if (k, h) not in heads:
            heads[k, h] = header(h, green[k], far[k], mode=mode)
    before = np.array([heads[k, h][1] for k, h in zip(of.tolist(), lines.tolist(), strict=True)], np.int64)
    taken = np.bincount(owner, width, len(of)).astype(np.int64)
    size = (before + taken + 7) // 8
    begin = np.cumsum(size) - size
    skip = np.cumsum(width) - width
    start = np.cumsum(taken) - taken
    bit = 8 * begin[owner] + before[owner] + skip - start[owner]
    total = int(size.sum())
    moved = value << (bit & 7)
    out = np.zeros(total + 3)
    for k in range(3):
        out += np.bincount((bit >> 3) + k, (moved >> 8 * k) & 255, total + 3)
    out = out.astype(np.uint8)
    for f, (k, h) in enumerate(zip(of.tolist(), lines.tolist(), strict=True)):
        head, n = heads[k, h]
        raw = np.frombuffer(head.to_bytes((n + 7) // 8, "little"), np.uint8)
        out[begin[f] : begin[f] + len(raw)] |= raw
    raw = out.tobytes()
    parts = [raw[i:j] for i, j in zip(begin.tolist(), (begin + size).tolist(), strict=True)]
    return [file_of(parts[i : i + n], lines[i : i + n].tolist()) for i, n in zip(first.tolist(), frames.tolist(), strict=True)]


#: Extra bits of each length and distance symbol, the least value it stands for, and a mask for that many bits.
EXTRA = np.maximum((np.arange(DISTANCES) - 2) >> 1, 0)
LEAST_VALUE = np.where(np.arange(DISTANCES) < 4, np.arange(DISTANCES), (2 + (np.arange(DISTANCES) & 1)) << EXTRA) + 1
LOW_BITS = (1 << np.arange(DISTANCES)) - 1
#: Distance symbols from this one on have more than 16 extra bits.
FARTHEST = 36
REVERSED = np.array([turned(k, CODE_BITS) for k in range(1 << CODE_BITS)])


def plain_heads(flat: list[bytes]) -> list[tuple | None]:
    """plain_head of each; frames of one file mostly begin alike and are read once."""
    out: list[tuple | None] = []
    seen, n, last = -1, 0, None
    for s in flat:
        value = int.from_bytes(s[:640], "little") >> 36
        size = int.from_bytes(s[1:5], "little")
        width, height = (size & 0x3FFF) + 1, (size >> 14 & 0x3FFF) + 1
        if last and value & ((1 << n) - 1) == seen and (not last[5] or (width, height) == last[:2]):
            out.append((width, height, *last[2:]))
            continue
        last = plain_head(s)
        if last:
            n = last[4] - 36
            seen = value & ((1 << n) - 1)
        out.append(last)
    return out


def plain_head(stream: bytes) -> tuple[int, int, list[int], list[int], int, int] | None:
    """Width, height, lengths of the green and the distance code, the first pixel's bit, the predictor or 0.

    None if pixels need more than these two codes, distances more bits than a window holds,
    or samples more than green subtracted and one predictor for all.
    """
    bits = Bits(stream[:640], 8)
    width, height = bits.take(14) + 1, bits.take(14) + 1
    bits.take(4)
    mode = 0
    while bits.take(1):
        kind = bits.take(2)
        if kind == PREDICTOR and not mode:
            side = bits.take(3) + 2
            modes = {p >> 8 & 15 for p in read_pixels(bits, (width - 1 >> side) + 1, (height - 1 >> side) + 1, False)}
            mode = min(modes)
            if len(modes) > 1 or mode not in (LEFT, TOP):
                return None
        elif kind != GREEN:
            return None
    if bits.take(1) or bits.take(1):
        return None
    green, red, blue, alpha, far = (read_prefix(bits, n).lengths for n in (LITERALS + LENGTHS, LITERALS, LITERALS, LITERALS, DISTANCES))
    single = [sum(map(bool, x)) <= 1 for x in (red, blue, alpha)]
    if not all(single) or max(*green, *far) > CODE_BITS or any(far[FARTHEST:]) or bits.at > 8 * 600:
        return None
    return width, height, green, far, bits.at, mode


def decode_planes(files: list[bytes]) -> list[np.ndarray]:
    """The green samples of each file's frames, one after another."""
    parts = [streams(f) for f in files]
    flat = [s for p in parts for s in p]
    heads = plain_heads(flat)
    out: list[np.ndarray | None] = [None if h else decode_stream(s)[:, :, 1].ravel() for h, s in zip(heads, flat, strict=True)]
    lanes = [k for k, h in enumerate(heads) if h]
    lanes.sort(key=lambda k: -heads[k][0] * heads[k][1])
    for k, plane in zip(lanes, in_step([flat[k] for k in lanes], [heads[k] for k in lanes]), strict=True):
        out[k] = restore(plane, heads[k][0], heads[k][5]) if heads[k][5] else plane
    ends = np.cumsum([0, *map(len, parts)])
    return [np.concatenate(out[i:j]) for i, j in zip(ends, ends[1:])]


def code_tables(codes: list[list[int]]) -> np.ndarray:
    """For each code, and each CODE_BITS bits to come, symbol << 4 | length; a lane's table after another's."""
    lengths = np.array(codes)
    alone = (lengths > 0).sum(axis=1) <= 1
    lane, symbol = np.nonzero(lengths)
    size = lengths[lane, symbol]
    order = np.lexsort((symbol, size, lane))
    lane, symbol, size = lane[order], symbol[order], size[order]
    fill = np.where(alone[lane], 1 << CODE_BITS, 1 << (CODE_BITS - size))
    entry = (symbol << 4 | np.where(alone[lane], 0, size)).astype(np.uint16)
    table = np.repeat(entry, fill)
    if len(table) != len(codes) << CODE_BITS:
        raise ValueError("a prefix code is not complete")
    return np.ascontiguousarray(table.reshape(len(codes), -1)[:, REVERSED]).ravel()


def in_step(data: list[bytes], heads: list[tuple]) -> list[np.ndarray]:
    """Decodes streams side by side, those with the most pixels first."""
    if not data:
        return []
    n = len(data)
    raw = np.frombuffer(b"".join(data) + b"\0\0\0\0", np.uint8).astype(np.int32)
    window = raw[:-2] | raw[1:-1] << 8 | raw[2:] << 16
    sizes = np.array([len(d) for d in data])
    at = 8 * (np.cumsum(sizes) - sizes) + np.array([h[4] for h in heads])
    pixels = np.array([h[0] * h[1] for h in heads])
    across = np.array([h[0] for h in heads])
    table, far = code_tables([h[2] for h in heads]), code_tables([h[3] for h in heads])
    near_x, near_y = np.array(NEARBY).T
    base = np.arange(n) << CODE_BITS
    out = np.zeros((int(pixels.max()), n), np.uint8)
    until, back = np.zeros(n, np.int64), np.ones(n, np.int64)
    copying = 0  # the last step at which some lane copies
    alive = np.searchsorted(-pixels, -np.arange(len(out)), side="left")
    mask = (1 << CODE_BITS) - 1

    def valued(symbol: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """value_of for many lanes: the values, and where reading goes on."""
        extra = EXTRA[symbol]
        return LEAST_VALUE[symbol] + (window[at >> 3] >> (at & 7) & LOW_BITS[extra]), at + extra

    for t, m in enumerate(alive.tolist()):
        p = at[:m]
        found = table[base[:m] + (window[p >> 3] >> (p & 7) & mask)]
        symbol, size = found >> 4, found & 15
        if t < copying:
            busy = np.flatnonzero(until[:m] > t)
            symbol[busy] = out[t - back[busy], busy]
            size[busy] = 0
        p += size
        hit = np.flatnonzero(symbol >= LITERALS)
        if len(hit):
            length, q = valued(symbol[hit] - LITERALS, at[hit])
            code = far[base[hit] + (window[q >> 3] >> (q & 7) & mask)]
            value, q = valued(code >> 4, q + (code & 15))
            distance = value - len(NEARBY)
            close = np.flatnonzero(distance <= 0)
            if len(close):
                by = value[close] - 1
                distance[close] = np.maximum(near_y[by] * across[hit[close]] + near_x[by], 1)
            if distance.max() > t:
                raise ValueError("back-reference before the first pixel")
            at[hit], back[hit], until[hit] = q, distance, t + length
            symbol[hit] = out[t - distance, hit]
            copying = max(copying, t + int(length.max()))
        out[t, :m] = symbol
    return [np.ascontiguousarray(out[: pixels[k], k]) for k in range(n)]
