"""Probability of words as the sum over all their segmentations into pieces of a fixed vocabulary.

The vocabulary is a public sentencepiece model. Words are read as UTF-8 bytes behind a leading
space, the place of the model's word mark; every single byte is a piece, so every word has a
segmentation. Pieces never cross words, so a text's probability is the product over its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece

from stakeflow.llm.wordhash import Words, mix, powers, slices, split

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
LONGEST = 16  # bytes; the few longer pieces are left out
GROUP_BYTES = 16 << 20  # of text whose distinct words are scored together
CELLS = 1 << 20  # of one forward table
_BASE = 0xD1342543DE82EF95
_BYTE = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


def read_model(path: str = VOCABULARY) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def piece_bytes(model: bytes) -> tuple[list[bytes], np.ndarray]:
    """(pieces, for each id of the model its piece or -1). The first 256 pieces are the bytes."""
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces = [bytes([b]) for b in range(256)]
    at = {p: i for i, p in enumerate(pieces)}
    of = np.full(sp.get_piece_size(), -1, np.int64)
    for i in range(len(of)):
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            continue
        name = sp.id_to_piece(i)
        raw = bytes([int(name[3:5], 16)]) if sp.is_byte(i) else name.replace("▁", " ").encode()
        if 0 < len(raw) <= LONGEST and b" " not in raw[1:]:
            if raw not in at:
                at[raw] = len(pieces)
                pieces.append(raw)
            of[i] = at[raw]
    return pieces, of


def tables(model: bytes) -> dict:
    """What tasks need of a model, as plain arrays that can be broadcast: a few MB, fixed by the vocabulary.

    Pieces are found by hash: its first bits lead to a short run of candidates.
    """
    pieces, of_id = piece_bytes(model)
    h = np.array([_hash(p) for p in pieces], np.uint64)
    order = np.argsort(h)
    top = (h[order] >> np.uint64(46)).astype(np.int64)
    return {
        "model": model, "of_id": of_id, "count": len(pieces), "order": np.append(order, [-1] * 8),
        "sorted": np.append(h[order], [np.uint64(2**64 - 1)] * 8),
        "start": np.searchsorted(top, np.arange(1 << 18)).astype(np.int32), "run": int(np.bincount(top).max()),
    }


def _hash(piece: bytes) -> int:
    raw = np.frombuffer(piece, np.uint8)
    total = (_BYTE[raw] * powers(_BASE, len(raw))).sum(keepdims=True)
    return mix(total + np.uint64(len(raw)))[0]


class Lattice:
    """Forward recursion over the pieces of ``tables``."""

    def __init__(self, made: dict):
        self.count, self.order, self.sorted, self.start, self.run = (
            made[k] for k in ("count", "order", "sorted", "start", "run")
        )

    def find(self, h: np.ndarray) -> np.ndarray:
        """Index of the piece with each hash; the number of pieces where there is none."""
        at = self.start[(h >> np.uint64(46)).astype(np.int64)]
        out = np.full(h.shape, self.count, np.int64)
        for step in range(self.run):
            hit = self.sorted[at + step] == h
            out[hit] = self.order[at[hit] + step]
        return out

    def marginals(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, logp: np.ndarray) -> np.ndarray:
        """Natural log probability of each word data[start:end] under each column of ``logp`` (pieces x models).

        Forward recursion: alpha[j] = sum over pieces ending at j of alpha[j - length] p(piece), kept as a
        scaled value and the logarithm of its scale. Words of one length go together.
        """
        models = logp.shape[1]
        known = np.vstack([np.exp(logp), np.zeros((1, models))])
        out = np.zeros((len(start), models))
        length = end - start
        order = np.argsort(length, kind="stable")
        edges = np.searchsorted(length[order], np.arange(length.max() + 2)) if len(order) and length.max() < 4096 else None
        for n in np.unique(length):
            own = order[edges[n]:edges[n + 1]] if edges is not None else np.flatnonzero(length == n)
            step = max(1, CELLS // (min(LONGEST, int(n) + 1) * (int(n) + 1) * models))
            for a in range(0, len(own), step):
                rows = own[a:a + step]
                out[rows] = self._forward(data, start[rows], int(n), known)
        return out

    def _forward(self, data: np.ndarray, start: np.ndarray, n: int, known: np.ndarray) -> np.ndarray:
        size, count, models = n + 1, len(start), known.shape[1]
        text = np.full((count, size), 32, np.uint8)
        text[:, 1:] = data[start[:, None] + np.arange(n)]
        sums = np.zeros((count, size + 1), np.uint64)
        np.cumsum(_BYTE[text] * powers(_BASE, size), axis=1, out=sums[:, 1:])
        inverse = powers(pow(_BASE, -1, 2**64), size)
        # ending[:, j, most - l]: the piece of length l that ends after j + 1 bytes.
        most = min(LONGEST, size)
        ending = np.full((count, size, most), self.count, np.int64)
        for l in range(1, most + 1):
            h = mix((sums[:, l:] - sums[:, :size - l + 1]) * inverse[:size - l + 1] + np.uint64(l))
            ending[:, l - 1:, most - l] = self.find(h)
        # alpha[:, most + j] times exp(taken_out) is the probability of the first j + 1 bytes. The logarithm
        # of the largest value is taken out every LONGEST bytes, before anything can underflow.
        alpha = np.zeros((count, most + size, models))
        alpha[:, most - 1] = 1
        taken_out = np.zeros((count, models))
        for j in range(size):
            window = alpha[:, j:j + most]
            if j and j % LONGEST == 0:
                largest = window.max(axis=1)
                taken_out += np.log(largest)
                window /= largest[:, None]
            alpha[:, most + j] = np.einsum("nlm,nlm->nm", window, np.take(known, ending[:, j], axis=0))
        return taken_out + np.log(alpha[:, -1])


class Encoder:
    """The model's own segmentation of words."""

    def __init__(self, made: dict):
        self.of_id = made["of_id"]
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=made["model"])

    def pieces(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(pieces of all words in a row, -1 where it is no piece here; number per word)."""
        ids = self.processor.encode(words)
        count = np.fromiter((len(x) for x in ids), np.int64, len(ids))
        flat = np.fromiter((i for x in ids for i in x), np.int64, int(count.sum()))
        return self.of_id[flat], count


def gathered(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The words data[start:end] as one Arrow string array."""
    size = end - start
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    at = np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data[at]))


class Distinct:
    """Distinct words of a group of documents, and the place of each word occurrence among them."""

    def __init__(self, parts: list[Words]):
        hashes = [w.hashes() for w in parts]
        shift = np.concatenate([[0], np.cumsum([len(w.data) for w in parts])])[:-1]
        self.data = np.concatenate([w.data for w in parts])
        start = np.concatenate([w.start + s for w, s in zip(parts, shift)])
        end = np.concatenate([w.end + s for w, s in zip(parts, shift)])
        self.hash, lead, self.place = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        self.start, self.end = start[lead], end[lead]
        tokens = np.concatenate([np.diff(w.first) for w in parts])
        self.tokens = tokens  # per document
        self.doc = np.repeat(np.arange(len(tokens)), tokens)

    def __len__(self) -> int:
        return len(self.hash)

    def arrow(self, chosen: np.ndarray | slice = slice(None)) -> pa.Array:
        return gathered(self.data, self.start[chosen], self.end[chosen])


def groups(column: pa.Array, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int, Distinct]]:
    """(first row, last row + 1, distinct words) of parts of a text column."""
    held, size, low = [], 0, 0
    for a, b, data, offsets in slices(column):
        held.append(split(data, offsets))
        size += len(data)
        if size >= limit:
            yield low, b, Distinct(held)
            held, size, low = [], 0, b
    if held:
        yield low, b, Distinct(held)
