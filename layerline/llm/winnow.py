"""Content-chosen anchors of texts (winnowing over rolling hashes), vectorised.

Every stretch of ``window + k - 1`` characters belongs to one anchor: of its k-grams the one with the least
hash, the leftmost where several are least. The anchor depends on the stretch's characters only, so equal
stretches belong to equal anchors at the same place of the stretch. The stretches of one anchor follow each other.
"""

from __future__ import annotations

import numpy as np

_BASES = (np.uint64(0x9E3779B97F4A7C15 | 1), np.uint64(0xC2B2AE3D27D4EB4F))
_MIXES = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9FB21C651E98DF25))
_SEGMENT = 1 << 20
_POS_BITS = np.uint64(22)
_POS_MASK = np.uint64((1 << 22) - 1)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    up, down = np.empty(n, np.uint64), np.empty(n, np.uint64)
    up[0] = down[0] = 1
    with np.errstate(over="ignore"):
        up[1:], down[1:] = base, inverse
        np.multiply.accumulate(up, out=up)
        np.multiply.accumulate(down, out=down)
    return up, down


_POWERS = [_powers(b, _SEGMENT + 2) for b in _BASES]


def gram_hashes(codes: np.ndarray, k: int, which: int = 0) -> np.ndarray:
    """64-bit hash of each k-gram of ``codes`` (code points, at most a segment); equal grams have equal hashes wherever they
    are. ``which`` picks one of two independent hashes."""
    n = len(codes)
    if n < k:
        return np.empty(0, np.uint64)
    (up, down), mix = _POWERS[which], _MIXES[which]
    with np.errstate(over="ignore"):
        c = codes.astype(np.uint64)
        c += np.uint64(1)
        c *= mix
        c ^= c >> np.uint64(29)
        c *= up[:n]
        total = np.empty(n + 1, np.uint64)
        total[0] = 0
        np.cumsum(c, out=total[1:])
        h = total[k:] - total[:-k]
        h *= down[: n - k + 1]
        h ^= h >> np.uint64(32)
        h *= mix
        h ^= h >> np.uint64(32)
    return h


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def stretch_hashes(texts: list[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Both hashes of every k-gram of every text, one text after the other; no text may exceed a segment."""
    first, second = [], []
    held: list[np.ndarray] = []
    size = 0

    def flush() -> None:
        nonlocal held, size
        if held:
            codes = np.concatenate(held)
            counts = np.array([len(c) for c in held])
            inside = np.arange(len(codes)) - np.repeat(np.cumsum(counts) - counts, counts) <= np.repeat(counts, counts) - k
            inside = inside[: len(codes) - k + 1]
            first.append(gram_hashes(codes, k)[inside])
            second.append(gram_hashes(codes, k, 1)[inside])
        held, size = [], 0

    for t in texts:
        codes = code_points(t)
        if size + len(codes) > _SEGMENT // 2:
            flush()
        held.append(codes)
        size += len(codes)
    flush()
    return (np.concatenate(first), np.concatenate(second)) if first else (np.empty(0, np.uint64),) * 2


def owners(h: np.ndarray, window: int) -> np.ndarray:
    """For each ``window`` consecutive values the position of the least one, the leftmost of several."""
    n = len(h)
    if n < window:
        return np.empty(0, np.int64)
    tagged = (h & ~_POS_MASK) | np.arange(n, dtype=np.uint64)
    rows = -(-n // window)
    grid = np.full(rows * window, _NONE, np.uint64)
    grid[:n] = tagged
    grid = grid.reshape(rows, window)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    behind = np.ascontiguousarray(np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1]).reshape(-1)
    return (np.minimum(behind[: n - window + 1], ahead[window - 1 : n]) & _POS_MASK).astype(np.int64)


def anchors(texts: list[str], k: int, window: int) -> tuple[np.ndarray, ...]:
    """(index of the text, position, hash, first stretch, number of stretches) of every anchor; texts below
    ``window + k - 1`` have none. Stretches are named by where they start.

    Short texts are joined into segments so that numpy works on long arrays; long texts are cut into segments that overlap by
    a full stretch, so the choice is the same as over the whole text (an anchor may then have its stretches in two rows).
    """
    stretch = window + k - 1
    out: list[tuple[np.ndarray, ...]] = []
    held: list[tuple[int, int, np.ndarray]] = []
    size = 0

    def flush() -> None:
        nonlocal held, size
        if held:
            codes = np.concatenate([c for _, _, c in held])
            lengths = np.array([len(c) for _, _, c in held])
            ends = np.cumsum(lengths)
            h = gram_hashes(codes, k)
            own = owners(h, window)
            # Stretches that run from one text into the next belong to no text.
            whole = np.ones(len(own), bool)
            for e in ends[:-1]:
                whole[e - stretch + 1 : e] = False
            begins = np.flatnonzero(whole & np.concatenate(([True], ~whole[:-1] | (own[1:] != own[:-1]))))
            count = np.add.reduceat(whole.astype(np.int64), begins) if len(begins) else begins
            text = np.searchsorted(ends, begins, side="right")
            start = (ends - lengths)[text]
            at = own[begins]
            moved = np.array([a for _, a, _ in held])[text] - start
            out.append((np.array([i for i, _, _ in held])[text], at + moved, h[at], begins + moved, count))
        held, size = [], 0

    for i, text in enumerate(texts):
        if text is None or len(text) < stretch:
            continue
        codes = code_points(text)
        step = _SEGMENT // 2
        for a in range(0, len(codes) - stretch + 1, step):
            part = codes[a : a + step + stretch - 1]
            if size + len(part) > step:
                flush()
            held.append((i, a, part))
            size += len(part)
    flush()
    if not out:
        z = np.empty(0, np.int64)
        return z, z, np.empty(0, np.uint64), z, z
    return tuple(np.concatenate(x) for x in zip(*out))
