"""Token ids of whole texts by a public byte-level tokenizer, for use inside tasks.

The library spends most of its time on words it has met before. A byte-level tokenizer of this kind never
forms a token across the step from a character that is not white space to one that is, so a text falls into
chunks (white space, then a word) whose ids can be looked up one by one. Only chunks not met before go to
the library, many in one call. Texts for which that reasoning doesn't hold go to the library whole.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from custlens.llm.arrow import utf8

CACHED_CHUNKS = 400_000
LONGEST_CACHED = 64  # bytes
TEXT_BYTES = 6_000_000  # encoded at once

_WHITE = b" \t\n\v\f\r"
_SPACE = np.zeros(256, bool)
_SPACE[list(_WHITE)] = True


def _beyond(data: np.ndarray) -> np.ndarray:
    """Places of white space outside ASCII and of the start of special tokens; texts with them are encoded whole."""
    first, second, third = data[:-2], data[1:-1], data[2:]
    general = (second == 0x80) & ((third <= 0x8A) | (third == 0xA8) | (third == 0xA9) | (third == 0xAF)) | (second == 0x81) & (third == 0x9F)
    found = (first == 0xE2) & general | (first == 0xE1) & (second == 0x9A) | (first == 0xE3) & (second == 0x80) & (third == 0x80)
    first, second = data[:-1], data[1:]
    pair = (first == 0xC2) & ((second == 0x85) | (second == 0xA0)) | (first == ord("<")) & (second == ord("|"))
    return np.concatenate([np.flatnonzero(found), np.flatnonzero(pair)])


def public_tokenizer(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


_encoders: dict[str, ChunkEncoder] = {}


def worker_encoder(path: str) -> ChunkEncoder:
    """The encoder of this process. The library never gives back all the memory of a tokenizer, and worker processes run
    very many tasks, so a process makes one and keeps it, with the chunks it has met."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def vocabulary_size(path: str) -> int:
    """One more than the largest id, read once on the driver."""
    return len(worker_encoder(path).token_bytes)


class ChunkEncoder:
    """``tokenizers`` ids of many texts. Memory is bounded by ``cached`` chunks of at most LONGEST_CACHED bytes."""

    def __init__(self, path: str, cached: int = CACHED_CHUNKS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.token_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.token_bytes[i] = len(token)  # one character of the byte alphabet per byte
        self.cached = cached
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.ends = np.zeros(1, np.int64)  # ids of chunk i: ids[ends[i]:ends[i + 1]]
        self.used = np.zeros(0, np.int64)

    def _keep_repeated(self) -> None:
        """Make room: only chunks used more than once stay, or none if those are too many as well."""
        stay = np.flatnonzero(self.used > 1)
        if len(stay) > self.cached // 2:
            self._forget()
            return
        chunks = list(self.known)
        sizes = (self.ends[1:] - self.ends[:-1])[stay]
        self.ids = self._expand(stay, sizes)
        self.ends = np.concatenate([[0], np.cumsum(sizes)])
        self.known = {chunks[i]: k for k, i in enumerate(stay.tolist())}
        self.used = np.ones(len(stay), np.int64)

    def _expand(self, run: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        before = np.cumsum(sizes) - sizes
        return self.ids[np.repeat(self.ends[run] - before, sizes) + np.arange(int(sizes.sum()))]

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, chunks: list[bytes]) -> None:
        """Ids of new chunks: joined, encoded in long stretches, cut again by the bytes of the tokens."""
        # A first word, and white space at the end of a text, would run into their neighbours.
        apart = [c[0] not in _WHITE or c[-1] in _WHITE for c in chunks]
        inner = [c for c, a in zip(chunks, apart) if not a]
        first = [c for c, a in zip(chunks, apart) if a]
        order, encoded, lengths = inner + first, [], []
        for a in range(0, len(inner), 2000):
            part = inner[a : a + 2000]
            ids = np.array(self._library([b"".join(part).decode()])[0], np.uint32)
            edges = np.cumsum(list(map(len, part)))
            cuts = np.searchsorted(np.cumsum(self.token_bytes[ids]), edges, side="left") + 1
            encoded.append(ids)
            lengths.append(np.diff(cuts, prepend=0))
        if first:
            alone = self._library([c.decode() for c in first])
            encoded.append(np.array([i for x in alone for i in x], np.uint32))
            lengths.append(np.array([len(x) for x in alone], np.int64))
        self.known.update(zip(order, range(len(self.known), len(self.known) + len(order))))
        self.ids = np.concatenate([self.ids, *encoded])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.concatenate(lengths))])
        self.used = np.concatenate([self.used, np.zeros(len(order), np.int64)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text starts (one entry more than texts). Null counts as empty."""
        if len(self.known) > self.cached:
            self._keep_repeated()
        data, offsets = utf8(texts)
        begin = _SPACE[data]
        begin[1:] &= ~begin[:-1]
        begin[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        starts = np.flatnonzero(begin)
        row = np.searchsorted(offsets, starts, side="right") - 1
        is_whole = np.zeros(len(texts), bool)
        is_whole[row[np.diff(starts, append=len(data)) > LONGEST_CACHED]] = True
        is_whole[np.searchsorted(offsets, _beyond(data), side="right") - 1] = True
        chunks = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(np.ascontiguousarray(data))]
        )
        if is_whole.any():
            keep = ~is_whole[row]
            chunks, row = chunks.filter(pa.array(keep)), row[keep]
        coded = chunks.dictionary_encode()
        words = coded.dictionary.to_pylist()
        find = self.known.get
        place = np.array([find(w, -1) for w in words], np.int64)
        missing = np.flatnonzero(place < 0)
        if len(missing):
            new = [words[i] for i in missing.tolist()]
            self._learn(new)
            place[missing] = [self.known[w] for w in new]
        run = place[coded.indices.to_numpy()]
        self.used += np.bincount(run, minlength=len(self.used))
        sizes = self.ends[run + 1] - self.ends[run]
        ids = self._expand(run, sizes)
        edges = np.searchsorted(row, np.arange(len(texts) + 1))
        bounds = np.concatenate([[0], np.cumsum(sizes)])[edges]
        if not is_whole.any():
            return ids, bounds
        whole = np.flatnonzero(is_whole).tolist()
        lengths, parts, at = np.diff(bounds), [], 0
        for i, alone in zip(whole, self._library([texts[i].as_py() for i in whole])):
            parts += [ids[at : bounds[i]], np.array(alone, np.uint32)]
            at, lengths[i] = bounds[i], len(alone)
        return np.concatenate([*parts, ids[at:]]), np.concatenate([[0], np.cumsum(lengths)])
