"""Whole-corpus tokenisation with a fixed vocabulary file of the `tokenizers` library.

Vocabularies that drop white space tokenise a text as the concatenation of its chunks between spaces and line feeds, so a
batch of texts is split in Arrow, its distinct chunks are encoded once by the library itself, and the ids are gathered
with numpy. Results equal `Tokenizer.encode(text, add_special_tokens=False).ids` (tests hold them against each other).
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

VOCABULARY = "word_bpe_49k.json"
#: Distinct chunks kept between batches in one Python worker.
KEEP = 200_000
#: Chunks of these characters are in normal form, and fall into the runs of PART whatever stands around them.
LETTERS = r"[A-Za-zÀ-ÖØ-öø-ÿ]"
PLAIN = re.compile(r"[!-&(-~À-ÖØ-öø-ÿ]+")
PART = re.compile(LETTERS + r"+|[0-9]|[!-&(-/:-@\[-`{-~]+")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Encodes batches of texts; holds the tokenizer and the ids of frequent chunks."""

    def __init__(self, path: str, keep: int = KEEP):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        shape = json.loads(self.tokenizer.to_str())
        # The same model, for text that is normalised and parted by spaces already.
        split = {"type": "Split", "pattern": {"String": " "}, "behavior": "Removed", "invert": False}
        bytes_ = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        shape |= {"normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": [split, bytes_]}, "added_tokens": []}
        self.parted = Tokenizer.from_str(json.dumps(shape))
        self.parted.model._resize_cache(0) if hasattr(self.parted.model, "_resize_cache") else None  # chunks come once
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values(), default=0) + 1, bool)
        for token, i in vocab.items():
            self.ends[i] = token.endswith("</w>")
        self.keep = keep
        self.ids = pa.array([], pa.large_string())  # kept chunks; their ids lie in pool[start:start + size]
        self.pool = np.zeros(0, np.uint32)
        self.start = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)

    def _encode(self, dictionary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the chunks one after the other, and the number of each chunk's ids."""
        n = len(dictionary)
        parts: list = dictionary.to_pylist()
        word = pc.match_substring_regex(dictionary, f"^(?:{LETTERS}+|[.,])$").to_numpy(zero_copy_only=False)
        plain, many = word.copy(), np.ones(n, np.int64)
        for i in np.flatnonzero(~word).tolist():
            if PLAIN.fullmatch(chunk := parts[i]) and "<|" not in chunk:
                found = PART.findall(chunk)
                parts[i], many[i], plain[i] = " ".join(found), len(found), True
        size = np.zeros(n, np.int64)
        one = np.flatnonzero(plain)
        joined = np.array(self.parted.encode_batch_fast([" ".join([parts[i] for i in one.tolist()]).lower()], add_special_tokens=False)[0].ids, np.uint32)
        stop = np.concatenate([[0], np.flatnonzero(self.ends[joined]) + 1])
        if len(stop) != many[one].sum() + 1:
            raise ValueError("the vocabulary doesn't mark the ends of words")
        size[one] = np.diff(stop[np.concatenate([[0], np.cumsum(many[one])])])
        rest = np.flatnonzero(~plain)
        others = [e.ids for e in self.tokenizer.encode_batch_fast([parts[i] for i in rest.tolist()], add_special_tokens=False)]
        size[rest] = [len(x) for x in others]
        at = np.concatenate([[0], np.cumsum(size)])
        out = np.zeros(at[-1], np.uint32)
        out[gather(at[one], size[one])] = joined
        for i, x in zip(rest.tolist(), others):
            out[at[i] : at[i + 1]] = x
        return out, size

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other (null counts as empty), and where each text's ids begin (one more at the end)."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        spaced = pc.replace_substring(texts, "\n", " ")
        spaced = pc.replace_substring_regex(spaced, f"({LETTERS})([.,])( |$)", r"\1 \2\3")
        lists = pc.split_pattern(spaced, " ")
        coded = pc.dictionary_encode(lists.values if isinstance(lists, pa.LargeListArray) else lists.flatten())
        coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
        chunks, which = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        place = pc.fill_null(pc.index_in(chunks, value_set=self.ids), -1).to_numpy(zero_copy_only=False)
        new = np.flatnonzero(place < 0)
        ids, size = self._encode(chunks.take(pa.array(new)))
        pool = np.concatenate([self.pool, ids])
        first = np.zeros(len(chunks), np.int64)
        many = np.zeros(len(chunks), np.int64)
        old = place >= 0
        first[old], many[old] = self.start[place[old]], self.size[place[old]]
        first[new], many[new] = len(self.pool) + np.cumsum(size) - size, size
        offsets = np.asarray(lists.offsets, np.int64)
        counts = many[which]
        out = pool[gather(first[which], counts)]
        upto = np.concatenate([[0], np.cumsum(counts)])
        begins = upto[offsets - offsets[0]]
        self._remember(chunks, which, first, many, pool)
        return out, begins

    def _remember(self, chunks: pa.Array, which: np.ndarray, first: np.ndarray, many: np.ndarray, pool: np.ndarray) -> None:
        """Keep chunks seen twice in this batch, up to `keep`; then what was kept before, as far as there is room."""
        if len(self.ids) >= self.keep:
            return
        often = np.flatnonzero((np.bincount(which, minlength=len(chunks)) > 1) & (first >= len(self.pool)))[: self.keep - len(self.ids)]
        self.ids = pa.concat_arrays([self.ids, chunks.take(pa.array(often)).cast(pa.large_string())])
        at = len(self.pool) + np.cumsum(many[often]) - many[often]
        self.pool = np.concatenate([self.pool, pool[gather(first[often], many[often])]])
        self.start, self.size = np.concatenate([self.start, at]), np.concatenate([self.size, many[often]])


def gather(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Indexes of the runs first[i] .. first[i] + many[i] - 1, one run after the other."""
    upto = np.cumsum(many)
    total = int(upto[-1]) if len(upto) else 0
    kind = np.int32 if max(total, int(first.max(initial=0))) < 2**31 else np.int64
    return np.arange(total, dtype=kind) + np.repeat((first - (upto - many)).astype(kind), many)
