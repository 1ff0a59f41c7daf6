"""Token ids of whole Arrow text columns with the public ``tokenizers`` library.

Each distinct piece of text between ASCII white space is encoded once a batch, which gives the ids of the whole text:
the vocabulary's splitting pattern never takes white space into a token. Pieces of plain Latin letters go straight to
the BPE model; all others through the whole tokenizer (normaliser, splitter, special tokens)."""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: letters that normalise to themselves or, lower-cased, to one letter of this range
PLAIN = "^[A-Za-zÀ-ÖØ-öø-ÿ]+[.,]?$"
_LOADED: dict[str, "Encoder"] = {}


def gather(flat: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The runs flat[begin:begin+length], one after the other."""
    at = np.cumsum(length)
    return flat[np.repeat(begin - (at - length), length) + np.arange(at[-1] if len(at) else 0)]


class Encoder:
    """``cache``: so many words' ids are kept from batch to batch; the first ones seen, which are the common ones."""

    def __init__(self, name: str, cache: int = 100_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task a core already
        import public_tokenizers
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(public_tokenizers.path(name))
        self.code = "I" if self.whole.get_vocab_size(with_added_tokens=True) > 65536 else "H"
        self.dtype = np.dtype("<u4" if self.code == "I" else "<u2")
        # The byte-level alphabet writes a byte as a printable character; letters up to U+00FF have two bytes there.
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        chars = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(shown))}
        self.spelled = {c: "".join(chars[b] for b in chr(c).encode()) for c in range(192, 256)}
        self.most, self.words, self.others = cache, {}, {}

    @classmethod
    def load(cls, name: str) -> "Encoder":
        if name not in _LOADED:
            _LOADED[name] = cls(name)
        return _LOADED[name]

    def _look_up(self, texts: list[str], known: dict[str, bytes], make) -> tuple[np.ndarray, np.ndarray]:
        """(ids, lengths) of the texts, those not yet known by make(texts) -> lists of ids."""
        got = list(map(known.get, texts))
        missing = [i for i, x in enumerate(got) if x is None]
        for i, ids in zip(missing, make([texts[i] for i in missing])):
            got[i] = array(self.code, ids).tobytes()
        for i in missing[: max(0, self.most - len(known))]:
            known[texts[i]] = got[i]
        return np.frombuffer(b"".join(got), self.dtype), np.fromiter(map(len, got), np.int64, len(got)) // self.dtype.itemsize

    def _words(self, words: list[str]) -> list[list[int]]:
        tokenize, spelled = self.model.tokenize, self.spelled
        return [[t.id for t in tokenize(w if w.isascii() else w.translate(spelled))] for w in words]

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def ragged(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, lengths) of each distinct piece."""
        self.model = self.whole.model
        plain = pc.match_substring_regex(distinct, PLAIN)
        is_plain = plain.to_numpy(zero_copy_only=False)
        # plain pieces: the ids of the lower-cased word, and those of a full stop or comma behind it
        quick = distinct.filter(plain)
        low = pc.utf8_lower(quick)
        base = pc.utf8_rtrim(low, ".,").dictionary_encode()
        ids, length = self._look_up(base.dictionary.to_pylist(), self.words, self._words)
        begin, codes = np.cumsum(length) - length, base.indices.to_numpy(zero_copy_only=False)
        others, o_length = self._look_up([*distinct.filter(pc.invert(plain)).to_pylist(), ".", ","], self.others, self._whole)
        o_begin = len(ids) + np.cumsum(o_length) - o_length
        flat = np.concatenate([ids, others])
        # every piece as two runs of flat
        begins, lengths = np.zeros((len(distinct), 2), np.int64), np.zeros((len(distinct), 2), np.int64)
        begins[is_plain, 0], lengths[is_plain, 0] = begin[codes], length[codes]
        for k, mark in ((-2, "."), (-1, ",")):
            has = np.zeros(len(distinct), bool)
            has[is_plain] = pc.ends_with(low, mark).to_numpy(zero_copy_only=False)
            begins[has, 1], lengths[has, 1] = o_begin[k], o_length[k]
        begins[~is_plain, 0], lengths[~is_plain, 0] = o_begin[:-2], o_length[:-2]
        return gather(flat, begins.ravel(), lengths.ravel()), lengths.sum(1)

    def encode(self, column: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): row i has ids[bounds[i]:bounds[i+1]], with id ``end`` last if given. Null counts as empty."""
        split = pc.ascii_split_whitespace(column.cast(pa.large_string()).fill_null(""))
        of_row = np.diff(np.asarray(split.offsets, np.int64))
        pieces = split.flatten().dictionary_encode()
        ids, lengths = self.ragged(pieces.dictionary)
        codes = pieces.indices.to_numpy(zero_copy_only=False)
        of_piece = lengths[codes]
        flat = gather(ids, (np.cumsum(lengths) - lengths)[codes], of_piece)
        edges = np.concatenate([[0], np.cumsum(of_piece)])[np.concatenate([[0], np.cumsum(of_row)])]
        if end is None:
            return flat, edges
        return np.insert(flat, edges[1:], end), edges + np.arange(len(edges))


def text_slices(batches: Iterator[pa.RecordBatch], text: str, most: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Neighbouring batches put together and cut to about ``most`` bytes of text: more repeats to a batch, bounded memory."""
    from ._words import slices

    held, size = [], 0
    for b in slices(batches, text, most):
        n = pc.sum(pc.binary_length(b.column(text))).as_py() or 0
        if held and size + n > most:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
            pa.default_memory_pool().release_unused()  # workers live on from task to task
        held.append(b)
        size += n
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()
