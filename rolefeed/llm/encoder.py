"""Token ids of many texts by a public tokenizer file, each distinct word of a
batch encoded once."""
from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BATCH_BYTES = 24 << 20  # text whose words are looked at together
CALL_WORDS = 50_000  # distinct words encoded in one call
GATHER_TOKENS = 1 << 20  # ids put together at a time


class Encoder:
    """The ids of the tokenizers library with add_special_tokens=False.

    A byte-level tokenizer starts a new token at every single space between two
    characters that are no white space, and between a letter or digit and full
    stops and commas that end a word; parts cut there have the same ids alone
    as within the text. The parts of a batch are dictionary encoded and each
    distinct one goes through the library once. Texts with other spaces, and
    any other kind of tokenizer, are encoded whole."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        pre = config.get("pre_tokenizer") or {}
        self.by_part = (config.get("normalizer") is None and pre.get("type") == "ByteLevel"
                        and not pre.get("add_prefix_space") and pre.get("use_regex", True)
                        and not any(t.get("lstrip") or t.get("rstrip") or set(" .,") & set(t["content"])
                                    for t in config.get("added_tokens", [])))
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.size = max(vocab.values()) + 1
        self.opens = np.zeros(self.size, bool)  # ids of tokens that begin with a space
        self.opens[[i for t, i in vocab.items() if t.startswith("Ġ")]] = True

    def one(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def many(self, texts: pa.Array | pa.ChunkedArray) -> Iterator[np.ndarray]:
        """The ids of each text, in order; a null text has none."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = pc.fill_null(texts, "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BATCH_BYTES, side="right")))
            part = texts.slice(at, to - at)
            yield from self._batch(part) if self.by_part else (self.one(t.as_py()) for t in part)
            at = to
        pa.default_memory_pool().release_unused()

    def _batch(self, texts: pa.Array) -> Iterator[np.ndarray]:
        lists = pc.split_pattern(texts, " ")
        begin = lists.offsets.to_numpy().astype(np.int64)
        begin -= begin[0]
        encoded = lists.flatten().dictionary_encode()
        words, index = encoded.dictionary, encoded.indices.to_numpy()
        del lists, encoded

        # white space is allowed at the two ends of a text only
        empty = pc.equal(pc.binary_length(words), 0)
        left = _bools(pc.or_(empty, pc.not_equal(pc.utf8_ltrim_whitespace(words), words)))
        right = _bools(pc.or_(empty, pc.not_equal(pc.utf8_rtrim_whitespace(words), words)))
        whole = np.zeros(len(texts), bool)
        if left.any() or right.any():
            odd = left[index]
            odd[begin[:-1]] = False
            also = right[index]
            also[begin[1:] - 1] = False
            whole = np.add.reduceat(odd | also, begin[:-1], dtype=np.int64) > 0

        ids, starts, lengths = self._words(words, ~(left | right))
        size = lengths[index]
        size[begin[:-1]] = 0  # the first word of a text has no space before it
        heads: dict[str, np.ndarray] = {}
        first = words.take(pa.array(index[begin[:-1]])).to_pylist()
        ends = np.add.reduceat(size, begin[:-1], dtype=np.int64).cumsum()
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + GATHER_TOKENS, side="right")))
            n = size[begin[at]:begin[to]]
            cum = n.cumsum(dtype=np.int64)
            spots = np.repeat(starts[index[begin[at]:begin[to]]] - cum + n, n)
            spots += np.arange(len(spots))
            rest = ids[spots]
            done = ends[at - 1] if at else 0
            for i in range(at, to):
                if whole[i]:
                    yield self.one(texts[i].as_py())
                    continue
                head = heads.get(first[i])
                if head is None:
                    head = heads[first[i]] = self.one(first[i])
                yield np.concatenate((head, rest[(ends[i - 1] if i else 0) - done:ends[i] - done]))
            at = to

    def _words(self, words: pa.Array, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of every word with a space before it, one after the other,
        and where those of each word begin and how many they are."""
        cores = pc.utf8_rtrim(words, ".,")
        cut = pc.and_(pc.and_(pa.array(plain), pc.not_equal(cores, words)), pc.match_substring_regex(cores, r"[\pL\pN]$"))
        keys = pc.if_else(cut, cores, words).dictionary_encode()
        key_of = keys.indices.to_numpy()
        alone = np.zeros(len(keys.dictionary), bool)
        alone[key_of[~plain]] = True
        key_ids, key_starts, key_sizes = self._keys(keys.dictionary, alone)
        tail_of = np.full(len(words), -1)
        tails = pc.replace_substring_regex(words.filter(cut), r"(?s)^.*?([.,]+)$", r"\1").dictionary_encode()
        tail_of[_bools(cut)] = tails.indices.to_numpy()
        tail_ids = [self.one(t) for t in tails.dictionary.to_pylist()]
        tail_sizes = np.array([len(t) for t in tail_ids] + [0])

        own = key_sizes[key_of]
        lengths = own + tail_sizes[tail_of]
        starts = lengths.cumsum() - lengths
        ids = np.empty(int(lengths.sum()), "<u4")
        before = own.cumsum() - own
        spots = np.arange(int(own.sum()))
        ids[spots + np.repeat(starts - before, own)] = key_ids[spots + np.repeat(key_starts[key_of] - before, own)]
        for t, tail in enumerate(tail_ids):
            at = np.flatnonzero(tail_of == t)
            for j, x in enumerate(tail.tolist()):
                ids[starts[at] + own[at] + j] = x
        return ids, starts, lengths.astype(np.int32)

    def _keys(self, keys: pa.Array, alone: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for distinct keys: many in one call, cut where a token
        begins with a space; those marked, and calls that do not come apart,
        one by one."""
        starts, sizes = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        parts, total = [], 0

        def single(at: list[int]) -> None:
            nonlocal total
            for i in at:
                ids = self.one(" " + keys[i].as_py())
                starts[i], sizes[i] = total, len(ids)
                parts.append(ids)
                total += len(ids)

        together = np.flatnonzero(~alone)
        for at in range(0, len(together), CALL_WORDS):
            some = together[at:at + CALL_WORDS]
            names = keys.take(pa.array(some))
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names), " ")[0].as_py()
            ids = self.one(" " + joined)
            opens = np.flatnonzero(self.opens[ids])
            if len(opens) != len(some):
                single(some.tolist())
                continue
            starts[some], sizes[some] = opens + total, np.diff(np.append(opens, len(ids)))
            parts.append(ids)
            total += len(ids)
        single(np.flatnonzero(alone).tolist())
        return np.concatenate(parts) if parts else np.zeros(0, "<u4"), starts, sizes


def _bools(mask: pa.Array) -> np.ndarray:
    return mask.to_numpy(zero_copy_only=False)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
