"""Token ids of whole texts by the tokenizers or sentencepiece library, inside tasks."""

from __future__ import annotations

import hashlib
import json
import os
from itertools import chain

import numpy as np
import pyarrow as pa

from ledgerline.llm.arrays import SPACE, flat

KEPT_CHUNKS = 800_000
ENCODE_BYTES = 8 << 20
#: Chunks that the library gets as one text, where they surely stay apart.
JOINED_CHUNKS = 256
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARK = np.zeros(256, bool)  # visible ASCII but letters
_MARK[33:127] = ~_LETTER[33:127]
_made: dict[str, Encoder] = {}


def digest_of(path: str) -> str:
    """Names a tokenizer version: its file and the library that reads it."""
    import sentencepiece
    import tokenizers

    version = tokenizers.__version__ if path.endswith(".json") else sentencepiece.__version__
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + version.encode()).hexdigest()


def encoder(path: str) -> Encoder:
    """One encoder per Python worker."""
    if path not in _made:
        _made[path] = Encoder(path)
    return _made[path]


def cuts_at_words(config: dict) -> bool:
    """True for a byte-level tokenizer with the usual split pattern: a letter followed by an ASCII non-letter always ends a
    piece, and so does a lone line feed before a letter; a space between an ASCII mark or digit and a letter begins one. Chunks
    cut there are encoded one by one with the same ids."""
    split = config.get("pre_tokenizer") or {}
    return (
        config.get("normalizer") is None
        and split.get("type") == "ByteLevel"
        and split.get("use_regex", True)
        and not split.get("add_prefix_space")
        and config.get("truncation") is None
        and config.get("padding") is None
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in config["added_tokens"])
    )


class Encoder:
    """ids(texts) gives all ids and the bounds of each text. Where the tokenizer allows it, texts are cut into chunks (about
    words) and each distinct chunk is encoded once while it is remembered; else whole texts are encoded. When too many chunks
    are remembered, those that were met in one call only are forgotten, and all if that is not enough."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.chunks, self.added, self.length = False, [], None
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: model.encode(texts, num_threads=1)
        else:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            with open(path, encoding="utf-8") as f:
                config = json.load(f)
            self.chunks = cuts_at_words(config)
            self.added = [t["content"].encode() for t in config["added_tokens"]]
            tokenizer.no_padding()
            tokenizer.no_truncation()
            self.encode = lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            if self.chunks:  # every symbol of a byte-level token stands for one byte, but added tokens are text
                own = tokenizer.get_vocab(with_added_tokens=True)
                self.length = np.zeros(max(own.values(), default=-1) + 1, np.int64)
                self.length[list(own.values())] = [len(t) for t in own]
                for t in config["added_tokens"]:
                    self.length[t["id"]] = len(t["content"].encode())
        self._forget()

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, bounds = flat(texts)
        starts = self._starts(data, bounds)
        pieces = pa.Array.from_buffers(
            pa.large_string(), len(starts), [None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data)]
        ).dictionary_encode()
        at = self._known(pieces.dictionary.to_pylist())[pieces.indices.to_numpy()]
        size = self.size[at]
        end = np.concatenate(([0], np.cumsum(size)))
        ids = self.pool[np.repeat(self.begin[at] - end[:-1], size) + np.arange(end[-1])]
        return ids, end[np.searchsorted(starts, bounds)]

    def _starts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        first = np.zeros(len(data) + 1, bool)
        if self.chunks and len(data) > 2:
            letter = _LETTER[data]
            ends = letter.copy()
            ends[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
            first[1:-1] = ends[:-1] & ~letter[1:] & (data[1:] < 0x80)
            first[2:-1] |= (data[:-2] < 0x80) & ~SPACE[data[:-2]] & (data[1:-1] == 10) & letter[2:]
            first[1:-2] |= _MARK[data[:-2]] & (data[1:-1] == 32) & letter[2:]
            content = data.tobytes()
            for token in self.added:
                at = content.find(token)
                while at >= 0:
                    first[at + 1 : at + len(token)] = False
                    at = content.find(token, at + len(token))
        first[bounds[:-1]] = True
        return np.flatnonzero(first[: len(data)])

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.begin, self.size, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.met = np.zeros(0, np.int32)

    def _keep_frequent(self) -> None:
        """Forget the chunks that only one call had."""
        stay = self.met > 1
        names = [name for name, keep in zip(self.index, stay.tolist(), strict=True) if keep]  # in order of their numbers
        begin, size = self.begin[stay], self.size[stay]
        end = np.cumsum(size)
        self.pool = self.pool[np.repeat(begin - end + size, size) + np.arange(size.sum())]
        self.index, self.begin, self.size = dict(zip(names, range(len(names)), strict=True)), end - size, size
        self.met = np.ones(len(names), np.int32)  # they have to be met again

    def _full(self) -> bool:
        return len(self.index) > KEPT_CHUNKS or len(self.pool) > 8 * KEPT_CHUNKS

    def _known(self, pieces: list[str]) -> np.ndarray:
        if self._full():
            self._keep_frequent()
            if self._full():
                self._forget()
        new = [p for p in pieces if p not in self.index]
        if new:
            found, each = self._encoded(new)
            self.begin = np.concatenate((self.begin, len(self.pool) + np.cumsum(each) - each))
            self.size = np.concatenate((self.size, each))
            self.pool = np.concatenate((self.pool, found))
            self.met = np.concatenate((self.met, np.zeros(len(new), np.int32)))
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
        at = np.fromiter(map(self.index.__getitem__, pieces), np.int64, len(pieces))
        self.met[at] += 1  # pieces are distinct
        return at

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of distinct pieces, and how many each has. Chunks that begin with an ASCII non-letter and end with a letter may
        stand side by side: each border ends a piece. The library gets these as long texts, and the bytes that the ids spell
        tell the chunks apart."""
        apart = [p[0] < "\x80" and not p[0].isalpha() and p[-1] < "\x80" and p[-1].isalpha() if p else False for p in pieces] if self.length is not None else []
        if not any(apart):
            found = self.encode(pieces)
            each = np.fromiter(map(len, found), np.int64, len(found))
            return np.fromiter(chain.from_iterable(found), np.int32, int(each.sum())), each
        side = np.array(apart)
        chunks = [p for p, keep in zip(pieces, apart, strict=True) if keep]
        texts = ["".join(chunks[k : k + JOINED_CHUNKS]) for k in range(0, len(chunks), JOINED_CHUNKS)]
        long = self.encode(texts)
        ids = np.fromiter(chain.from_iterable(long), np.int32, sum(map(len, long)))
        spelt = np.cumsum(self.length[ids])
        want = np.cumsum(np.fromiter((len(c.encode()) for c in chunks), np.int64, len(chunks)))
        stop = np.searchsorted(spelt, want)
        if not np.array_equal(spelt[np.minimum(stop, len(spelt) - 1)], want):  # ids that don't spell the chunks: one by one
            found = self.encode(pieces)
            each = np.fromiter(map(len, found), np.int64, len(found))
            return np.fromiter(chain.from_iterable(found), np.int32, int(each.sum())), each
        alone = self.encode([p for p, keep in zip(pieces, apart, strict=True) if not keep])
        each = np.zeros(len(pieces), np.int64)
        each[side] = np.diff(np.concatenate(([0], stop + 1)))
        each[~side] = [len(f) for f in alone]
        joined = np.repeat(side, each)
        out = np.empty(len(joined), np.int32)
        out[joined] = ids
        out[~joined] = np.fromiter(chain.from_iterable(alone), np.int32, int((~joined).sum()))
        return out, each
