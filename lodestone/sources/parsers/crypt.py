"""The standard security handler of PDF files, for files that open without a password.

RC4 and AES as the revisions 2 to 6 of the handler use them. AES works on all blocks of a stream
at once; its tables come from the field's arithmetic.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable
from functools import lru_cache

import numpy as np

#: Fixed value: what fills a password up to 32 bytes.
PADDING = bytes.fromhex("28bf4e5e4e758a4164004e56fffa01082e2e00b6d0683e802f0ca9fe6453697a")


def _field() -> tuple[np.ndarray, Callable[[int], np.ndarray]]:
    """The substitution box, and tables of products in the field of 256 elements."""
    power = [1]
    while len(power) < 255:
        x = power[-1] << 1
        power.append((x ^ (0x11B if x > 255 else 0)) ^ power[-1])
    place = {x: k for k, x in enumerate(power)}
    inverse = np.array([0] + [power[-place[x] % 255] for x in range(1, 256)], np.uint8)
    box = inverse ^ 0x63
    for k in range(1, 5):
        box = box ^ (inverse << k | inverse >> (8 - k))
    return box, lambda by: np.array([0] + [power[(place[x] + place[by]) % 255] for x in range(1, 256)], np.uint8)


_BOX, _times = _field()
_UNBOX = np.argsort(_BOX).astype(np.uint8)
_SHIFT = np.array([r + 4 * ((c + r) % 4) for c in range(4) for r in range(4)])
_UNSHIFT = np.argsort(_SHIFT)
#: For each k, where the byte k rows below stands, and the tables by which rows are multiplied.
_BELOW = [np.array([4 * c + (r + k) % 4 for c in range(4) for r in range(4)]) for k in range(4)]
_MIX, _UNMIX = ([_times(x) for x in by] for by in ((2, 3, 1, 1), (14, 11, 13, 9)))

#: What a byte of each row adds to its column in a round, as one word.
_FUSED = np.stack([_MIX[(j - r) % 4][_BOX] for j in range(4) for r in range(4)], axis=-1).reshape(256, 4, 4).transpose(1, 0, 2).copy().view(np.uint32).ravel()
_ROWS = np.tile(np.arange(4) * 256, 4)


def _mixed(s: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    a, b, c, d = (t[s[:, at]] for t, at in zip(tables, _BELOW))
    return a ^ b ^ c ^ d


@lru_cache(64)
def _round_keys(key: bytes) -> np.ndarray:
    n = len(key) // 4
    words, constant = [np.frombuffer(key, np.uint8)[4 * k : 4 * k + 4] for k in range(n)], 1
    while len(words) < 4 * (n + 7):
        w = words[-1]
        if len(words) % n == 0:
            w = _BOX[np.roll(w, -1)] ^ np.array([constant, 0, 0, 0], np.uint8)
            constant = int(_MIX[0][constant])
        elif n > 6 and len(words) % n == 4:
            w = _BOX[w]
        words.append(words[-n] ^ w)
    return np.concatenate(words).reshape(-1, 16)


def encrypt_blocks(keys: np.ndarray, s: np.ndarray) -> np.ndarray:
    s = s ^ keys[0]
    for k in keys[1:-1]:
        s = np.bitwise_xor.reduce(_FUSED[s[:, _SHIFT] + _ROWS].reshape(-1, 4, 4), axis=2).view(np.uint8) ^ k
    return _BOX[s][:, _SHIFT] ^ keys[-1]


def decrypt_blocks(keys: np.ndarray, s: np.ndarray) -> np.ndarray:
    s = _UNBOX[(s ^ keys[-1])[:, _UNSHIFT]]
    for k in keys[-2:0:-1]:
        s = _UNBOX[_mixed(s ^ k, _UNMIX)[:, _UNSHIFT]]
    return s ^ keys[0]


def cbc_encrypt(key: bytes, iv: bytes, data: bytes) -> bytes:
    """Whole blocks, chained."""
    keys, held, out = _round_keys(key), np.frombuffer(iv, np.uint8)[None], []
    for b in np.frombuffer(data, np.uint8).reshape(-1, 1, 16):
        held = encrypt_blocks(keys, b ^ held)
        out.append(held)
    return np.concatenate(out).tobytes() if out else b""


def cbc_decrypt(key: bytes, iv: bytes, data: bytes) -> bytes:
    """Whole blocks, chained; a broken block at the end is left out."""
    blocks = np.frombuffer(data[: len(data) // 16 * 16], np.uint8).reshape(-1, 16)
    if not len(blocks):
        return b""
    return (decrypt_blocks(_round_keys(key), blocks) ^ np.concatenate((np.frombuffer(iv, np.uint8)[None], blocks[:-1]))).tobytes()


def aes(key: bytes, data: bytes) -> bytes:
    """Data that begin with their first vector and end with padding."""
    out = cbc_decrypt(key, data[:16], data[16:]) if len(data) >= 32 else b""
    return out[: -out[-1]] if out and 1 <= out[-1] <= 16 else out


def rc4(key: bytes, data: bytes) -> bytes:
    s, j = list(range(256)), 0
    for i, k in enumerate((key * (256 // len(key) + 1))[:256]):
        x = s[i]
        j = (j + x + k) & 255
        s[i] = s[j]
        s[j] = x
    out, i, j = bytearray(data), 0, 0
    for k, b in enumerate(data):
        i = (i + 1) & 255
        x = s[i]
        j = (j + x) & 255
        y = s[i] = s[j]
        s[j] = x
        out[k] = b ^ s[(x + y) & 255]
    return bytes(out)


def hardened(salt: bytes, revision: int, password: bytes = b"") -> bytes:
    """The hash of a password: of revision 5 plain, of revision 6 in 64 rounds or more."""
    k = hashlib.sha256(password + salt).digest()
    done, last = 0, 0
    while revision >= 6 and (done < 64 or last > done - 32):
        e = cbc_encrypt(k[:16], k[16:32], (password + k) * 64)
        k = hashlib.new(("sha256", "sha384", "sha512")[sum(e[:16]) % 3], e).digest()
        done, last = done + 1, e[-1]
    return k[:32]


def early_key(e: dict, first_id: bytes) -> bytes:
    """The key of a file of revisions 2 to 4."""
    r, n = e.get("R", 2), 5 if e.get("V", 1) == 1 else e.get("Length", 128 if e.get("V") == 4 else 40) // 8
    unseen = r >= 4 and e.get("EncryptMetadata") == b"false"
    k = hashlib.md5(PADDING + bytes(e["O"])[:32] + struct.pack("<I", e["P"] & 0xFFFFFFFF) + first_id + (b"\xff" * 4 if unseen else b"")).digest()
    for _ in range(50 if r >= 3 else 0):
        k = hashlib.md5(k[:n]).digest()
    return k[:n]


def early_check(key: bytes, r: int, first_id: bytes) -> bytes:
    """What the entry U of a file of revisions 2 to 4 begins with, if the key is right."""
    if r == 2:
        return rc4(key, PADDING)
    u = hashlib.md5(PADDING + first_id).digest()
    for k in range(20):
        u = rc4(bytes(x ^ k for x in key), u)
    return u


class Handler:
    """Decryption of a file by its encryption dictionary; ValueError for a file that needs a password or another handler."""

    def __init__(self, e: dict, first_id: bytes):
        self.version = e.get("V", 0)
        if e.get("Filter") != "Standard" or self.version not in (1, 2, 4, 5):
            raise ValueError("the file is encrypted by an unknown method")
        r, u = e.get("R", 2), bytes(e["U"])
        if self.version == 5:
            right = hardened(u[32:40], r) == u[:32]
            self.key = cbc_decrypt(hardened(u[40:48], r), bytes(16), bytes(e["UE"])[:32]) if right else b""
        else:
            self.key = early_key(e, first_id)
            check = early_check(self.key, r, first_id)
            right = u[: len(check)] == check
        if not right:
            raise ValueError("the file is encrypted with a password")
        filters = e.get("CF") or {}
        of = lambda use: (filters.get(e.get(use, "Identity")) or {}).get("CFM", "None") if self.version >= 4 else "V2"
        self.of_strings, self.of_streams = of("StrF"), of("StmF")
        self.plain_metadata = e.get("EncryptMetadata") == b"false"

    def decrypted(self, data: bytes, number: int, generation: int, method: str) -> bytes:
        if method == "None":
            return data
        key, is_aes = self.key, method in ("AESV2", "AESV3")
        if self.version < 5:
            salted = key + struct.pack("<I", number)[:3] + struct.pack("<I", generation)[:2] + (b"sAlT" if is_aes else b"")
            key = hashlib.md5(salted).digest()[: min(len(key) + 5, 16)]
        return aes(key, data) if is_aes else rc4(key, data)

    def strings(self, value, number: int, generation: int):
        """A value with its strings decrypted."""
        if isinstance(value, bytearray):
            return bytearray(self.decrypted(bytes(value), number, generation, self.of_strings))
        if isinstance(value, dict):
            return {k: self.strings(v, number, generation) for k, v in value.items()}
        return [self.strings(v, number, generation) for v in value] if type(value) is list else value
