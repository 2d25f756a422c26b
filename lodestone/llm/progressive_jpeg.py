"""Progressive JPEG (ITU-T T.81, Huffman, 8 bit) in numpy.

`Decoder` reads any progressive (SOF2) file with one or three components: every scan, spectral
selection and successive approximation included, is added into one coefficient array for each
component.  The arrays are dequantised, inverse-transformed in numpy, chroma is upsampled by
repetition, and the result is a full-resolution RGB tensor.

`write_payload` keeps bytes losslessly as the coefficients of a colour image with chroma of half the
width and height (4:2:0): each half byte is one coefficient, 64 to a block, first the luma blocks, then
both chroma planes; all quantisers are 1.  Half byte q is the AC coefficient that T.81 writes with size 4 and bits q
(8 to 15, or -15 to -8), and the DC coefficient q + 16; so pixels stay within their range.  Every coefficient
of a scan then has the same size, each scan's Huffman table has a single symbol, and a scan is a stream
of half bytes or bits.  The decoder recognises such one-symbol scans; any other scan is read
symbol by symbol.  The two ways give the same coefficients.
"""

from __future__ import annotations

import struct

import numpy as np

# The zigzag order of T.81, figure A.6.
ZIGZAG = np.array([
    0, 1, 8, 16, 9, 2, 3, 10, 17, 24, 32, 25, 18, 11, 4, 5, 12, 19, 26, 33, 40, 48, 41, 34, 27, 20, 13, 6, 7, 14, 21, 28,
    35, 42, 49, 56, 57, 50, 43, 36, 29, 22, 15, 23, 30, 37, 44, 51, 58, 59, 52, 45, 38, 31, 39, 46, 53, 60, 61, 54, 47, 55, 62, 63,
])
SOI, EOI, SOF2, DHT, DQT, DRI, SOS, COM, RST0 = b"\xff\xd8", b"\xff\xd9", 0xC2, 0xC4, 0xDB, 0xDD, 0xDA, 0xFE, 0xD0
#: MCUs of 16 x 16 pixels in a row of a payload image: 16 * 4095 stays below the format's 65535.
ROW_MCUS = 4095
#: Luma blocks and all blocks of an MCU; payload bytes of a block.
_LUMA, _BLOCKS, _BYTES = 4, 6, 32
_DCT = np.array([[(np.sqrt(1 / 8) if u == 0 else 0.5) * np.cos((2 * x + 1) * u * np.pi / 16) for x in range(8)] for u in range(8)], "float32")
_NOTE = b"payload "


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _table(kind: int, slot: int, symbol: int) -> bytes:
    """A Huffman table with one symbol, coded as a single 0."""
    return _segment(DHT, bytes([kind << 4 | slot, 1] + [0] * 15 + [symbol]))


def _scan(component: int, ss: int, se: int, ah: int, al: int) -> bytes:
    return _segment(SOS, bytes([1, component, 0, ss, se, ah << 4 | al]))


def _halves(data: np.ndarray) -> np.ndarray:
    """The half bytes of data, the upper one first."""
    return np.stack([data >> 4, data & 15], -1).reshape(-1)


def _entropy(bits: np.ndarray) -> bytes:
    """Bits as entropy-coded bytes: filled with ones, and 0 stuffed after each 255."""
    coded = np.packbits(bits)
    if spare := -bits.size % 8:
        coded[-1] |= (1 << spare) - 1
    return _stuffed(coded)


def _stuffed(coded: np.ndarray) -> bytes:
    return coded.tobytes().replace(b"\xff", b"\xff\x00")


def pad(data: bytes) -> bytes:
    """data with zero bytes up to a positive multiple of 64."""
    return data + b"\0" * (-len(data) % 64 if data else 64)


def write_payload(payload: bytes) -> bytes:
    """A colour progressive JPEG whose coefficients are the payload (a positive multiple of 64 bytes)."""
    n = len(payload) // _BYTES
    mcus = -(-n // _BLOCKS)
    wide = min(mcus, ROW_MCUS)
    high = -(-mcus // wide)
    if high > ROW_MCUS:
        raise ValueError("the payload is too long for one image")
    mcus = wide * high
    half = np.zeros((mcus * _BLOCKS, 64), "uint8")
    half[:n] = _halves(np.frombuffer(payload, "uint8")).reshape(n, 64)
    parts = half[: mcus * _LUMA], half[mcus * _LUMA : mcus * (_LUMA + 1)], half[mcus * (_LUMA + 1) :]
    out = [SOI, _segment(COM, _NOTE + str(len(payload)).encode()), _segment(DQT, bytes([0] + [1] * 64))]
    frame = b"".join(bytes([c, hv, 0]) for c, hv in ((1, 0x22), (2, 0x11), (3, 0x11)))
    out.append(_segment(SOF2, struct.pack(">BHHB", 8, high * 16, wide * 16, 3) + frame))
    # First pass over DC, but for the last bit: a restart after each block, so that a difference is the value itself (8 to 15).
    out += [_segment(DRI, struct.pack(">H", 1)), _table(0, 0, 4)]
    for c, q in enumerate(parts, 1):
        coded = np.empty((len(q), 3), "uint8")
        coded[:, 0] = (8 | q[:, 0] >> 1) << 3 | 7  # code 0, four bits, filled with ones
        coded[:, 1] = 0xFF
        coded[:, 2] = RST0 + np.arange(len(q)) % 8
        out += [_scan(c, 0, 0, 0, 1), coded.tobytes()[:-2]]
    out += [_segment(DRI, struct.pack(">H", 0)), _table(1, 0, 3)]
    # First passes over AC by spectral selection: code 0, then three bits.
    for a, b in ((1, 5), (6, 63)):
        for c, q in enumerate(parts, 1):
            first = (q[:, a : b + 1] >> 1).reshape(-1)
            if spare := len(first) % 2:
                first = np.append(first, 15).astype("uint8")
            out += [_scan(c, a, b, 0, 1), _stuffed(first[::2] << 4 | first[1::2])]
    # Successive approximation: the last bit of every coefficient's size.
    out.append(_table(1, 0, 0))
    for c, q in enumerate(parts, 1):
        low = q & 1 ^ (q < 8)
        out += [_scan(c, 0, 0, 1, 0), _entropy(q[:, 0] & 1)]
        low[:, 0] = 0  # the code for the end of the block, before its 63 correction bits
        out += [_scan(c, 1, 63, 1, 0), _entropy(low)]
    return b"".join([*out, EOI])


class _Reader:
    """Bits of one restart interval, for scans that are read symbol by symbol."""

    def __init__(self, data: bytes):
        self.n, self.value, self.at = len(data) * 8, int.from_bytes(data, "big"), 0

    def take(self, k: int) -> int:
        self.at += k
        shift = self.n - self.at
        return (self.value >> shift if shift >= 0 else self.value << -shift) & ((1 << k) - 1)

    def symbol(self, codes: dict[tuple[int, int], int]) -> int:
        code = 0
        for length in range(1, 17):
            code = code << 1 | self.take(1)
            if (length, code) in codes:
                return codes[length, code]
        raise ValueError("no such Huffman code")


def _extend(v: int, size: int) -> int:
    return v if size == 0 or v >> (size - 1) else v - (1 << size) + 1


class Decoder:
    """coefficients: for each component an int32 array (rows of blocks, blocks in a row, 64 in zigzag order)."""

    def __init__(self, data: bytes):
        self.quant: dict[int, np.ndarray] = {}
        self.codes: dict[int, dict[tuple[int, int], int]] = {}
        self.restart, self.note = 0, b""
        self.components: dict[int, dict] = {}
        if data[:2] != SOI:
            raise ValueError("no JPEG")
        at = 2
        while at < len(data):
            marker = data[at + 1]
            if marker == EOI[1]:
                break
            length = struct.unpack_from(">H", data, at + 2)[0]
            body, at = data[at + 4 : at + 2 + length], at + 2 + length
            if marker == DQT:
                self._quantisers(body)
            elif marker == DHT:
                self._huffman(body)
            elif marker == DRI:
                self.restart = struct.unpack(">H", body)[0]
            elif marker == COM:
                self.note = body
            elif marker == SOF2:
                self._frame(body)
            elif 0xC0 <= marker <= 0xCF and marker not in (0xC8, 0xCC):
                raise ValueError("not a progressive Huffman frame")
            elif marker == SOS:
                at = self._scan(body, data, at)
        self.coefficients = [c["blocks"] for c in self.components.values()]

    def _quantisers(self, body: bytes) -> None:
        while body:
            wide, slot = body[0] >> 4, body[0] & 15
            n = 128 if wide else 64
            self.quant[slot] = np.frombuffer(body[1 : 1 + n], ">u2" if wide else "u1").astype("int32")
            body = body[1 + n :]

    def _huffman(self, body: bytes) -> None:
        while body:
            counts, symbols, codes, code = body[1:17], body[17:], {}, 0
            for length, count in enumerate(counts, 1):
                for _ in range(count):
                    codes[length, code] = symbols[len(codes)]
                    code += 1
                code <<= 1
            self.codes[body[0]] = codes
            body = body[17 + len(codes) :]

    def _frame(self, body: bytes) -> None:
        depth, self.height, self.width, n = struct.unpack_from(">BHHB", body)
        if depth != 8:
            raise ValueError("only 8-bit samples")
        for i in range(n):
            c, hv, q = body[6 + 3 * i : 9 + 3 * i]
            self.components[c] = {"h": hv >> 4, "v": hv & 15, "q": q}
        self.h, self.v = max(c["h"] for c in self.components.values()), max(c["v"] for c in self.components.values())
        self.mcus = (-(-self.height // (8 * self.v)), -(-self.width // (8 * self.h)))
        for c in self.components.values():
            # Own size for scans of one component, whole MCUs for interleaved ones.
            c["own"] = tuple(-(-(-(-size * c[k] // most)) // 8) for size, k, most in ((self.height, "v", self.v), (self.width, "h", self.h)))
            c["blocks"] = np.zeros((self.mcus[0] * c["v"], self.mcus[1] * c["h"], 64), "int32")

    def _intervals(self, data: bytes, at: int) -> tuple[list[bytes], int]:
        """Entropy-coded bytes of a scan by restart interval, unstuffed, and where the next marker is."""
        parts, begin, i = [], at, at
        while True:
            i = data.index(b"\xff", i)
            if data[i + 1] == 0:
                i += 2
            elif RST0 <= data[i + 1] < RST0 + 8:
                parts.append(data[begin:i])
                begin = i = i + 2
            else:
                parts.append(data[begin:i])
                return [p.replace(b"\xff\x00", b"\xff") for p in parts], i

    def _scan(self, body: bytes, data: bytes, at: int) -> int:
        n = body[0]
        parts = [(self.components[body[1 + 2 * i]], body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15) for i in range(n)]
        ss, se, approx = body[1 + 2 * n : 4 + 2 * n]
        ah, al = approx >> 4, approx & 15
        if n == 1 and (end := self._one_symbol(parts[0], ss, se, ah, al, data, at)):
            return end
        intervals, end = self._intervals(data, at)
        if n == 1:
            c = parts[0][0]
            units = [[(parts[0], y, x)] for y in range(c["own"][0]) for x in range(c["own"][1])]
        else:
            units = [[(p, my * p[0]["v"] + y, mx * p[0]["h"] + x) for p in parts for y in range(p[0]["v"]) for x in range(p[0]["h"])] for my in range(self.mcus[0]) for mx in range(self.mcus[1])]
        step = self.restart or len(units)
        for k, coded in enumerate(intervals):
            bits, last, run = _Reader(coded), {}, 0
            for unit in units[k * step : (k + 1) * step]:
                for (c, dc, ac), y, x in unit:
                    block = c["blocks"][y, x]
                    if ss == 0:
                        if ah:
                            block[0] |= bits.take(1) << al
                        else:
                            size = bits.symbol(self.codes[dc])
                            last[id(c)] = last.get(id(c), 0) + _extend(bits.take(size), size)
                            block[0] = last[id(c)] << al
                    elif ah:
                        run = self._refine(bits, self.codes[0x10 | ac], block, ss, se, al, run)
                    else:
                        run = self._first(bits, self.codes[0x10 | ac], block, ss, se, al, run)
        return end

    @staticmethod
    def _first(bits: _Reader, codes: dict, block: np.ndarray, ss: int, se: int, al: int, run: int) -> int:
        if run:
            return run - 1
        k = ss
        while k <= se:
            rs = bits.symbol(codes)
            r, size = rs >> 4, rs & 15
            if size == 0 and r < 15:
                return (1 << r) - 1 + bits.take(r)
            k += r
            if size:
                block[k] = _extend(bits.take(size), size) * (1 << al)
            k += 1
        return 0

    @staticmethod
    def _refine(bits: _Reader, codes: dict, block: np.ndarray, ss: int, se: int, al: int, run: int) -> int:
        def correct(k: int) -> None:
            if bits.take(1):
                block[k] += (1 << al) if block[k] > 0 else -(1 << al)

        k = ss
        if not run:
            while k <= se:
                rs = bits.symbol(codes)
                r, size, new = rs >> 4, rs & 15, 0
                if size:
                    new = (1 << al) if bits.take(1) else -(1 << al)
                elif r < 15:
                    run = (1 << r) + bits.take(r)
                    break
                while k <= se:
                    if block[k]:
                        correct(k)
                    elif r == 0:
                        block[k] = new
                        k += 1
                        break
                    else:
                        r -= 1
                    k += 1
        if run:
            for k in range(k, se + 1):
                if block[k]:
                    correct(k)
            return run - 1
        return 0

    def _one_symbol(self, part: tuple, ss: int, se: int, ah: int, al: int, data: bytes, at: int) -> int:
        """Reads a scan of one component whose table leaves no choice; 0 if this is no such scan."""
        c, dc, ac = part
        rows, cols = c["own"]
        blocks, n = c["blocks"][:rows, :cols], rows * cols
        table = self.codes.get(dc if ss == 0 else 0x10 | ac, {})
        if ss == 0 and ah == 0:
            # Each interval is one byte, a code 0 and four bits from 8 on, and a restart marker but for the last.
            if self.restart != 1 or table != {(1, 0): 4}:
                return 0
            raw = np.frombuffer(data, "uint8", offset=at)[: 3 * n - 2]
            first = raw[::3].astype("int32")
            if len(raw) < 3 * n - 2 or (first & 0xC7 != 0x47).any() or (raw[1::3] != 0xFF).any() or data[at + 3 * n - 2] != 0xFF:
                return 0
            blocks[..., 0] = ((first >> 3) << al).reshape(rows, cols)
            return at + 3 * n - 2
        if self.restart:
            return 0
        if ss and ah == 0:
            if table != {(1, 0): 3}:
                return 0
        elif ss and not (table == {(1, 0): 0} and blocks[..., ss : se + 1].all()):
            return 0
        end = at
        while data[(end := data.index(b"\xff", end)) + 1] == 0:
            end += 2
        coded = np.frombuffer(data[at:end].replace(b"\xff\x00", b"\xff"), "uint8")
        if ss == 0:
            blocks[..., 0] |= np.unpackbits(coded, count=n).reshape(rows, cols).astype("int32") << al
        elif ah == 0:
            v = _halves(coded)[: n * (se - ss + 1)].astype("int32")
            v -= 7 * (v < 4)
            blocks[..., ss : se + 1] = (v << al).reshape(rows, cols, -1)
        else:
            bits = np.unpackbits(coded, count=n * (se - ss + 2)).reshape(rows, cols, -1)[..., 1:]
            part = blocks[..., ss : se + 1]
            part += np.where(part > 0, bits, -bits.astype("int32")) << al
        return end

    def payload(self) -> bytes:
        """The bytes that write_payload stored."""
        if not self.note.startswith(_NOTE):
            raise ValueError("no payload image")
        size = int(self.note[len(_NOTE) :])
        blocks = np.concatenate([c.reshape(-1, 64) for c in self.coefficients])[: size // _BYTES]
        half = (blocks + 15 * (blocks < 0)).astype("uint8")
        half[:, 0] = blocks[:, 0] - 16
        half = half.reshape(-1)
        return (half[::2] << 4 | half[1::2]).tobytes()

    def _plane(self, c: dict) -> np.ndarray:
        rows, cols, _ = c["blocks"].shape
        square = np.empty((rows * cols, 64), "float32")
        square[:, ZIGZAG] = (c["blocks"] * self.quant[c["q"]]).reshape(-1, 64)
        pixels = _DCT.T @ square.reshape(-1, 8, 8) @ _DCT
        pixels = pixels.reshape(rows, cols, 8, 8).transpose(0, 2, 1, 3).reshape(rows * 8, cols * 8)
        # Upsampling by repetition; the ratio of sampling factors need not be whole.
        y = np.arange(self.height) * c["v"] // self.v
        x = np.arange(self.width) * c["h"] // self.h
        if c["v"] < self.v:
            pixels = pixels[y]
        if c["h"] < self.h:
            pixels = pixels[:, x]
        return pixels[: self.height, : self.width]

    def rgb(self) -> np.ndarray:
        """uint8 tensor (height, width, 3)."""
        planes = [self._plane(c) for c in self.components.values()]
        if len(planes) == 1:
            grey = np.clip(np.rint(planes[0] + 128), 0, 255).astype("uint8")
            return np.repeat(grey[..., None], 3, 2)
        y, cb, cr = planes[:3]
        # JFIF's conversion.
        full = np.empty((*y.shape, 3), "float32")
        full[..., 0] = y + 1.402 * cr
        full[..., 1] = y - 0.344136 * cb - 0.714136 * cr
        full[..., 2] = y + 1.772 * cb
        full += 128
        return np.clip(np.rint(full, out=full), 0, 255, out=full).astype("uint8")
