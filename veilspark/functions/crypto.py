"""Authenticated and format-preserving encryption over whole batches, from the public standards.

AES (FIPS 197) works on arrays of blocks, so a batch of values costs a few array
operations a round. On it: SIV (RFC 5297) and FF1 (NIST SP 800-38G). Only the forward
direction of AES is needed.
"""
from __future__ import annotations

import hashlib
import hmac
from collections.abc import Sequence
from functools import lru_cache

import numpy as np

from veilspark.plans.errors import RunError

#: Contexts that separate the keys derived from one master key; parameters of a run,
#: so ciphertexts made under other contexts can be read by naming those.
ENCRYPT_CONTEXT = "veilspark/encrypt/aes-siv/v1"
FORMAT_CONTEXT = "veilspark/format/ff1/v1"
#: A value's shape must allow at least this many values.
MIN_DOMAIN = 1_000_000


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Substitution box and multiplication by 2 and 3, computed from their definition."""
    double = lambda a: ((a << 1) ^ (0x1B if a & 0x80 else 0)) & 0xFF
    log, exp, x = [0] * 256, [0] * 256, 1
    for i in range(255):
        exp[i], log[x] = x, i
        x ^= double(x)
    box = np.zeros(256, np.uint8)
    for a in range(256):
        inv = exp[(255 - log[a]) % 255] if a else 0
        b = inv
        for s in (1, 2, 3, 4):
            b ^= ((inv << s) | (inv >> (8 - s))) & 0xFF
        box[a] = b ^ 0x63
    two = np.array([double(a) for a in range(256)], np.uint8)
    return box, two, two ^ np.arange(256, dtype=np.uint8)


_SHIFT = np.array([0, 5, 10, 15, 4, 9, 14, 3, 8, 13, 2, 7, 12, 1, 6, 11])


def expand_key(key: bytes) -> np.ndarray:
    """Round keys, one row of 16 bytes each."""
    box = _tables()[0]
    n, words, rcon = len(key) // 4, [list(key[i : i + 4]) for i in range(0, len(key), 4)], 1
    for i in range(n, 4 * (n + 7)):
        w = list(words[-1])
        if i % n == 0:
            w = [int(box[b]) for b in (*w[1:], w[0])]
            w[0] ^= rcon
            rcon = ((rcon << 1) ^ (0x11B if rcon & 0x80 else 0)) & 0xFF
        elif n > 6 and i % n == 4:
            w = [int(box[b]) for b in w]
        words.append([a ^ b for a, b in zip(w, words[-n])])
    return np.array(words, np.uint8).reshape(-1, 16)


def encrypt_blocks(blocks: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """AES of ``(n, 16)`` bytes."""
    box, two, three = _tables()
    s = blocks ^ keys[0]
    for r in range(1, len(keys)):
        s = box[s][:, _SHIFT]
        if r < len(keys) - 1:
            a = s.reshape(-1, 4, 4)
            b, c, d = np.roll(a, -1, 2), np.roll(a, -2, 2), np.roll(a, -3, 2)
            s = (two[a] ^ three[b] ^ c ^ d).reshape(-1, 16)
        s = s ^ keys[r]
    return s


def _doubled(block: np.ndarray) -> np.ndarray:
    """Doubling in GF(2^128) of ``(n, 16)`` bytes."""
    out = (block << 1).astype(np.uint8)
    out[:, :-1] |= block[:, 1:] >> 7
    out[:, -1] ^= np.where(block[:, 0] >> 7, 0x87, 0).astype(np.uint8)
    return out


def cmac(messages: np.ndarray, length: int, keys: np.ndarray) -> np.ndarray:
    """CMAC of messages of one length, as rows of bytes."""
    n = len(messages)
    k1 = _doubled(encrypt_blocks(np.zeros((1, 16), np.uint8), keys))
    count = max(1, -(-length // 16))
    data = np.zeros((n, count * 16), np.uint8)
    data[:, :length] = messages[:, :length]
    if length == count * 16:
        data[:, -16:] ^= k1[0]
    else:
        data[:, length] = 0x80
        data[:, -16:] ^= _doubled(k1)[0]
    x = np.zeros((n, 16), np.uint8)
    for i in range(count):
        x = encrypt_blocks(x ^ data[:, 16 * i : 16 * i + 16], keys)
    return x


def _rows(values: Sequence[bytes], length: int) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint8).reshape(len(values), length).copy() if length else np.zeros((len(values), 0), np.uint8)


def _s2v(texts: np.ndarray, length: int, associated: bytes, keys: np.ndarray) -> np.ndarray:
    d = cmac(np.zeros((1, 16), np.uint8), 16, keys)
    d = _doubled(d) ^ cmac(_rows([associated], len(associated)), len(associated), keys)
    if length >= 16:
        t = texts.copy()
        t[:, -16:] ^= d[0]
        return cmac(t, length, keys)
    t = np.zeros((len(texts), 16), np.uint8)
    t[:, :length] = texts
    t[:, length] = 0x80
    return cmac(t ^ _doubled(d)[0], 16, keys)


def _ctr(data: np.ndarray, length: int, iv: np.ndarray, keys: np.ndarray) -> np.ndarray:
    start = iv.copy()
    start[:, 8] &= 0x7F
    start[:, 12] &= 0x7F
    low = start[:, 12:].astype(np.uint64) @ np.array([1 << 24, 1 << 16, 1 << 8, 1], np.uint64)
    out = data.copy()
    for i in range(-(-length // 16)):
        block = start.copy()
        block[:, 12:] = ((low + np.uint64(i)).astype(">u4").view(np.uint8)).reshape(-1, 4)
        stream = encrypt_blocks(block, keys)
        out[:, 16 * i : 16 * i + 16] ^= stream[:, : min(16, length - 16 * i)]
    return out


def _by_length(values: Sequence[bytes]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for i, v in enumerate(values):
        out.setdefault(len(v), []).append(i)
    return out


def siv_encrypt(values: Sequence[bytes], key: bytes, associated: bytes) -> list[bytes]:
    """SIV of each value under one key and associated text: tag, then ciphertext."""
    mac, enc = expand_key(key[: len(key) // 2]), expand_key(key[len(key) // 2 :])
    out: list[bytes] = [b""] * len(values)
    for length, at in _by_length(values).items():
        texts = _rows([values[i] for i in at], length)
        tag = _s2v(texts, length, associated, mac)
        body = _ctr(texts, length, tag, enc)
        for i, t, b in zip(at, tag, body):
            out[i] = t.tobytes() + b.tobytes()
    return out


def siv_decrypt(values: Sequence[bytes], key: bytes, associated: bytes) -> list[bytes | None]:
    """The inverse; None where a value was not made with this key and associated text."""
    mac, enc = expand_key(key[: len(key) // 2]), expand_key(key[len(key) // 2 :])
    out: list[bytes | None] = [None] * len(values)
    for length, at in _by_length(values).items():
        if length < 16:
            continue
        raw = _rows([values[i] for i in at], length)
        texts = _ctr(raw[:, 16:], length - 16, raw[:, :16], enc)
        tag = _s2v(texts, length - 16, associated, mac)
        for i, t, given, text in zip(at, tag, raw[:, :16], texts):
            if hmac.compare_digest(t.tobytes(), given.tobytes()):
                out[i] = text.tobytes()
    return out


def derive_key(master: str, context: str) -> bytes:
    """A 32-byte key: HMAC-SHA256 under the bytes of the master key's text."""
    return hmac.new(master.encode(), context.encode(), hashlib.sha256).digest()


PREFIX = "ENC1$"


def encrypt_values(values: Sequence[str], master: str, column: str, context: str = ENCRYPT_CONTEXT) -> list[str]:
    return [PREFIX + c.hex() for c in siv_encrypt([v.encode() for v in values], derive_key(master, context), column.encode())]


def decrypt_values(values: Sequence[str], master: str, column: str, context: str = ENCRYPT_CONTEXT) -> list[str | None]:
    raw = [bytes.fromhex(v[len(PREFIX) :]) if v.startswith(PREFIX) else b"" for v in values]
    return [None if t is None else t.decode() for t in siv_decrypt(raw, derive_key(master, context), column.encode())]


# FF1


def ff1(numbers: Sequence[int], width: int, tweak: bytes, key: bytes, encrypt: bool = True) -> list[int]:
    """FF1 in radix 10 of numbers of ``width`` digits under one tweak."""
    keys = expand_key(key)
    u = width // 2
    v = width - u
    ten_u, ten_v = 10**u, 10**v
    b = -(-((10**v - 1).bit_length()) // 8)
    d = 4 * -(-b // 4) + 4
    p = bytes([1, 2, 1, 0, 0, 10, 10, u % 256]) + width.to_bytes(4, "big") + len(tweak).to_bytes(4, "big")
    pad = (-len(tweak) - b - 1) % 16
    left, right = [x // ten_v for x in numbers], [x % ten_v for x in numbers]
    first = encrypt_blocks(_rows([p], 16), keys)
    # whole blocks of the tweak are the same for every value and round
    same = len(tweak) // 16 * 16
    for at in range(0, same, 16):
        first = encrypt_blocks(first ^ np.frombuffer(tweak[at : at + 16], np.uint8), keys)
    rest = tweak[same:]
    for step in range(10):
        i = step if encrypt else 9 - step
        source = right if encrypt else left
        head = rest + bytes(pad) + bytes([i])
        q = [head + x.to_bytes(b, "big") for x in source]
        data = _rows(q, len(q[0]))
        r = np.repeat(first, len(q), 0)
        for at in range(0, data.shape[1], 16):
            r = encrypt_blocks(r ^ data[:, at : at + 16], keys)
        stream = [r]
        for j in range(1, -(-d // 16)):
            mask = np.frombuffer(j.to_bytes(16, "big"), np.uint8)
            stream.append(encrypt_blocks(r ^ mask, keys))
        s = np.concatenate(stream, 1)[:, :d]
        m = ten_u if i % 2 == 0 else ten_v
        ys = [int.from_bytes(row.tobytes(), "big") for row in s]
        if encrypt:
            left, right = right, [(a + y) % m for a, y in zip(left, ys)]
        else:
            left, right = [(c - y) % m for c, y in zip(right, ys)], left
    return [a * ten_v + c for a, c in zip(left, right)]


def _shape(value: str, column: str) -> tuple[str, int, int]:
    """Classes of the characters, how many values share them, and the value's number."""
    shape, size, number = [], 1, 0
    for c in value:
        if "0" <= c <= "9":
            shape.append("D")
            size, number = size * 10, number * 10 + ord(c) - 48
        elif "A" <= c <= "Z":
            shape.append("U")
            size, number = size * 26, number * 26 + ord(c) - 65
        elif "a" <= c <= "z":
            shape.append("L")
            size, number = size * 26, number * 26 + ord(c) - 97
        elif c.isalnum():
            raise RunError("FPE_VALUE_UNSUPPORTED", "only ASCII letters and digits keep their format", f"column {column}")
        else:
            shape.append(c)
    if size < MIN_DOMAIN:
        raise RunError("FPE_DOMAIN_TOO_SMALL", "a value is too short to keep its format", f"column {column}")
    return "".join(shape), size, number


def format_values(values: Sequence[str], master: str, column: str, encrypt: bool = True, context: str = FORMAT_CONTEXT) -> list[str]:
    """Each value as another of the same shape; letters, digits and the rest keep their places."""
    key = derive_key(master, context)
    kinds = [[("D" if "0" <= c <= "9" else "U" if "A" <= c <= "Z" else "L" if "a" <= c <= "z" else "") for c in v] for v in values]
    groups: dict[tuple, list[int]] = {}
    numbers: list[int] = []
    for i, v in enumerate(values):
        shape, size, number = _shape(v, column)
        numbers.append(number)
        groups.setdefault((shape, "".join(k or "." for k in kinds[i]), size), []).append(i)
    out = [""] * len(values)
    for (shape, _, size), at in groups.items():
        width = max(6, len(str(size - 1)))
        tweak = column.encode() + b"\0" + shape.encode()
        todo = {i: numbers[i] for i in at}
        while todo:  # again for numbers that left the shape's range
            ids = list(todo)
            for i, x in zip(ids, ff1([todo[i] for i in ids], width, tweak, key, encrypt)):
                if x < size:
                    del todo[i]
                    chars = list(values[i])
                    for at_char in range(len(chars) - 1, -1, -1):
                        kind = kinds[i][at_char]
                        if kind:
                            x, digit = divmod(x, 10 if kind == "D" else 26)
                            chars[at_char] = chr(digit + (48 if kind == "D" else 65 if kind == "U" else 97))
                    out[i] = "".join(chars)
                else:
                    todo[i] = x
    return out
