"""Marginal probabilities of words over all ways to cut them into vocabulary pieces.

Words of one length are worked on together. A word is written as a space and its
bytes; a piece matches where the hash of a substring equals the hash of a piece.
Every single byte is a piece of its own, so each word has a way.
"""

import functools

import numpy as np

MIX = np.uint64(0x9E3779B97F4A7C15)


@functools.cache
def _byte_values() -> np.ndarray:
    return np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)


def _prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of each prefix of each row (rows of bytes of one length)."""
    out = np.zeros((data.shape[1] + 1, data.shape[0]), np.uint64)
    values = _byte_values()
    for k in range(data.shape[1]):
        out[k + 1] = out[k] * MIX + values[data[:, k]]
    return out


class Pieces:
    """Pieces as byte strings: the texts of a vocabulary, then the 256 single bytes."""

    def __init__(self, words: list[bytes]):
        self.words = words + [bytes([b]) for b in range(256)]
        self.n_texts = len(words)
        self.by_length = {}
        for n in sorted(set(map(len, words))):
            own = [i for i, w in enumerate(words) if len(w) == n]
            data = np.frombuffer(b"".join(words[i] for i in own), np.uint8).reshape(len(own), n)
            hashes = _prefix_hashes(data)[n]
            order = np.argsort(hashes)
            if (np.diff(hashes[order]) == 0).any():
                raise ValueError("two pieces share a hash")
            self.by_length[n] = (hashes[order], np.array(own, np.int64)[order])
        self.powers = {n: np.uint64(pow(int(MIX), n, 1 << 64)) for n in self.by_length}

    def matches(self, data: np.ndarray):
        """Per end: the pieces that end there, as (length, piece per row or -1).

        The single bytes come first, as length 0 to tell them from one-byte texts.
        """
        hashes = _prefix_hashes(data)
        found = [[] for _ in range(data.shape[1] + 1)]
        for end in range(1, data.shape[1] + 1):
            found[end].append((0, self.n_texts + data[:, end - 1].astype(np.int64)))
        for n, (keys, own) in self.by_length.items():
            if n > data.shape[1]:
                break
            parts = hashes[n:] - hashes[:-n] * self.powers[n]
            at = np.minimum(np.searchsorted(keys, parts), len(keys) - 1)
            hit = keys[at] == parts
            for start in np.flatnonzero(hit.any(axis=1)):
                found[start + n].append((n, np.where(hit[start], own[at[start]], -1)))
        return found


def _forward(found, log_p: np.ndarray, rows: int) -> np.ndarray:
    """Log probability of each prefix, summed over its segmentations."""
    padded = np.append(log_p, -np.inf)  # piece -1
    alpha = np.full((len(found), rows), -np.inf)
    alpha[0] = 0.0
    for end in range(1, len(found)):
        terms = np.stack([alpha[end - max(n, 1)] + padded[piece] for n, piece in found[end]])
        top = terms.max(axis=0)
        alpha[end] = top + np.log(np.exp(terms - top).sum(axis=0))
    return alpha


def _groups(words: list[bytes]):
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        n = int(lengths[own[0]]) if len(own) else 0
        # Matches take rows x length x piece lengths: long words go in smaller groups.
        step = max(1, 200_000 // (n + 1))
        for at in range(0, len(own), step):
            some = own[at:at + step]
            data = np.frombuffer(b"".join(b" " + words[i] for i in some), np.uint8)
            yield some, data.reshape(len(some), n + 1)


def marginals(pieces: Pieces, words: list[bytes], log_p: np.ndarray) -> np.ndarray:
    """Natural log of the probability of each word."""
    out = np.zeros(len(words))
    for some, data in _groups(words):
        out[some] = _forward(pieces.matches(data), log_p, len(some))[-1]
    return out


def expected(pieces: Pieces, words: list[bytes], weights: np.ndarray, log_p: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in the words, each word counted weights times."""
    total = np.zeros(len(pieces.words))
    padded = np.append(log_p, -np.inf)
    for some, data in _groups(words):
        found = pieces.matches(data)
        alpha = _forward(found, log_p, len(some))
        beta = np.full_like(alpha, -np.inf)
        beta[-1] = 0.0
        weight = weights[some]
        for end in range(len(found) - 1, 0, -1):
            for n, piece in found[end]:
                start = end - max(n, 1)
                here = padded[piece] + beta[end]
                use = np.exp(alpha[start] + here - alpha[-1]) * weight
                hit = piece >= 0
                total += np.bincount(piece[hit], use[hit], len(total))
                beta[start] = np.logaddexp(beta[start], here)
    return total
